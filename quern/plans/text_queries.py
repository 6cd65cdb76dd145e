"""Queries of the scalar rules and functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import fixed, rules
from quern.functions import text as T
from quern.plans.base import documents, q, query, sql_chosen, sql_signoff, sql_straight, sql_u, sql_with, sql_words, table, with_snippet, WS  # noqa: F401

WRAPPERS = ["", "Sure! Here is the text. ", "Here's your draft:\n", "Subject: x\n", "# Head\n", "```\ncode\n", "**bold** ", "- one\n- two\n", "[Your Name] ", "{city} <x> ", "<THINK> ", "[not one] "]


def sql_wrapper(c: str) -> str:
    t = sql_straight(c)
    first = f"string_split({t}, chr(10))[1]"
    place = f"list_filter(regexp_extract_all({t}, {q(fixed.BRACKETED)}), lambda x: regexp_matches(x, {q(fixed.PLACEHOLDER)}))"
    m = lambda x, p: f"regexp_matches({x}, {q(p)})"
    return (
        f"CASE WHEN {m(t, fixed.META_PREAMBLE)} OR {m(first, fixed.HERE_IS_DRAFT)} OR {m(t, fixed.SUBJECT)} THEN 'wrapper_preamble' "
        f"WHEN {m(t, fixed.HEADING)} OR {m(t, fixed.FENCE)} OR {m(t, fixed.BOLD)} OR {m(t, fixed.BULLETS)} THEN 'wrapper_markdown' "
        f"WHEN len({place}) > 0 THEN 'wrapper_placeholder' WHEN contains(lower({t}), '<think>') THEN 'wrapper_think' END"
    )


@query("wrapper_reasons", f"SELECT doc_id, {sql_wrapper('text')} AS reason FROM {sql_with(WRAPPERS, True)}")
def wrapper_reasons(spark, d):
    return with_snippet(documents(spark, d), WRAPPERS, True).select("doc_id", rules.wrapper_reason(F.col("text")).alias("reason"))


ERRORS = ["", " I could of gone.", " could of course go", " a deep-seeded fear", " Definately so", " they loose hope", " will loose hope", " seperated", " mute point.", " must, loose it", " alot of it"]


def sql_known_error(c: str) -> str:
    t = f"lower({sql_straight(c)})"
    plain = "|".join(w for w in rules.one_way_wrong() if w != "loose" and not w.endswith(" of"))
    of = "|".join(w for w in rules.one_way_wrong() if w.endswith(" of"))
    edge, end = r"(?:^|[^\p{L}\p{N}_''])", r"(?:$|[^\p{L}\p{N}_''])"
    cleared = rf"regexp_replace({t}, '({of})(\s+course)', '\2', 'g')"
    return (
        f"CASE WHEN regexp_matches({t}, '{edge}(?:{plain.replace(chr(39), chr(39) * 2)}){end}') OR regexp_matches({cleared}, '{edge}(?:{of}){end}') "
        f"OR regexp_matches({t}, '{edge}(?:{'|'.join(fixed.LOSE_CONTEXT).replace(chr(39), chr(39) * 2)})[^\\p{{L}}\\p{{N}}_'']+loose{end}') THEN 'known_error' END"
    )


@query("known_errors", f"SELECT doc_id, {sql_known_error('text')} AS reason FROM {sql_with(ERRORS)}")
def known_errors(spark, d):
    return with_snippet(documents(spark, d), ERRORS).select("doc_id", rules.known_error_reason(F.col("text")).alias("reason"))


LENGTHS = ["", "  x", " \nx", "\tx", "y", "x \t"]
_BAND = "CASE doc_id % 4 WHEN 0 THEN 'short' WHEN 1 THEN 'medium' WHEN 2 THEN 'long' END"


def sql_length(c: str, band: str | None, most: int = fixed.MAX_CHARS) -> str:
    n = f"len({sql_words(c)})"
    banded = " ".join(f"WHEN {band} = '{k}' AND {n} NOT BETWEEN {low // 2} AND {-(-3 * high // 2)} THEN 'length_words'" for k, (low, high) in fixed.BANDS.items()) if band else ""
    return f"CASE WHEN length({c}) NOT BETWEEN {fixed.MIN_CHARS} AND {most} THEN 'length_chars' {banded} WHEN contains({c}, '  ') THEN 'doubled_space' WHEN regexp_matches({c}, '(?m)[ \\t]$') THEN 'trailing_space' WHEN contains({c}, chr(9)) THEN 'tab' END"


@query("length_reasons", f"SELECT doc_id, {sql_length('text', _BAND)} AS reason FROM {sql_with(LENGTHS)}")
def length_reasons(spark, d):
    return with_snippet(documents(spark, d), LENGTHS).select("doc_id", rules.length_reason(F.col("text"), F.expr(_BAND)).alias("reason"))


PII = ["", " a.b+c@mail.example.org", " see https://x.example/y", " at 10.20.30.255 now", " id 123-45-6789", " call (212) 555-0187", " card 4111 1111 1111 1111", " card 4111111111111112", " +442079460958", " 202-\n555-0170"]


def sql_pii(c: str) -> str:
    m = lambda p: f"regexp_matches({c}, {q(p)})"
    o = fixed.OCTET
    digits = f"regexp_extract_all({c}, '[0-9]+')"

    def luhn(x: str) -> str:
        pick = f"list_transform(range(1, len({x}) + 1), lambda i: ({x})[len({x}) - i + 1]::INT * (CASE WHEN i % 2 = 0 THEN 2 ELSE 1 END))"
        return f"list_sum(list_transform({pick}, lambda v: CASE WHEN v > 9 THEN v - 9 ELSE v END)) % 10 = 0"

    runs = f"len(list_filter({digits}, lambda r: len(r) BETWEEN 13 AND 19 AND {luhn('r')})) > 0"
    laid = [r"\d{4}%s\d{4}%s\d{4}%s\d{4}(?:%s\d{3})?" % ((s,) * 4) for s in (" ", "-")] + [r"\d{4}%s\d{6}%s\d{5}" % (s, s) for s in (" ", "-")]
    spaced = " OR ".join(f"len(list_filter(list_transform(regexp_extract_all({c}, {q(rf'(?:^|[^0-9])({p})(?:$|[^0-9])')}, 1), lambda r: regexp_replace(r, '[ -]', '', 'g')), lambda r: {luhn('r')})) > 0" for p in laid)
    nanp = r"(?:^|[^\d+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?:$|\D)"
    return (
        f"CASE WHEN {m(fixed.EMAIL)} THEN 'email' WHEN {m(fixed.URL)} THEN 'url' WHEN {m(rf'(?:^|[^0-9.]){o}(?:\.{o}){{3}}(?:$|\.$|[^0-9.]|\.[^0-9])')} THEN 'ipv4' "
        f"WHEN {m(fixed.SSN)} THEN 'ssn' WHEN {runs} OR {spaced} THEN 'card' WHEN {m(nanp)} OR {m(fixed.E164)} THEN 'phone' END"
    )


def _pii(c):
    def first(n):
        kinds = rules.pii_kinds(c, n)
        phone = n.rlike(fixed.NANP) | n.rlike(fixed.E164)
        return F.coalesce(*[F.when(phone if k == "phone" else hit, k) for k, hit in kinds.items() if k not in ("ipv6", "street")])

    return F.when(rules.pii_screen(c), rules.bound(rules.numbers(c), first))


@query("pii_reasons", f"SELECT doc_id, {sql_pii('text')} AS reason FROM {sql_with(PII)}")
def pii_reasons(spark, d):
    """The kinds that SQL can express: without IPv6, streets and loose phone shapes."""
    return with_snippet(documents(spark, d), PII).select("doc_id", _pii(F.col("text")).alias("reason"))


@query("pii_three_views", f"WITH t AS (SELECT doc_id, text, array_to_string({sql_words('text')}, ' ') AS line FROM {sql_with(PII)}) SELECT doc_id, coalesce({sql_pii('text')}, {sql_pii('line')}, {sql_pii(chr(40) + 'regexp_replace(line, ' + q(r'([-.])\s+') + ', ' + q(chr(92) + '1') + ', ' + q('g') + '))')}) AS reason FROM t")
def pii_three_views(spark, d):
    return with_snippet(documents(spark, d), PII).select("doc_id", rules.first_of_views(F.col("text"), _pii).alias("reason"))


@query("pii_full")
def pii_full(spark, d):
    """All kinds and views."""
    more = [*PII, " fe80::1:2 x", " 12 Main Street", " 5 St Louis", " Order: 2125550187", " 2125550187", " +44 (0)20 7946 0958"]
    return with_snippet(documents(spark, d), more).select("doc_id", rules.pii_reason_any(F.col("text")).alias("reason"))


TERMS, ALLOW = ["SECRET", "HIV", "bomb", "surgery", "drug deal", "the and"], ["the and"]
SENSITIVE = ["", " top SECRET file", " a secret", " two Bombs", " the surgeries", " Drug  Deals", " HIV's", " bombed", " the and "]


def _sensitive_sql(c: str) -> str:
    edge, end = r"(?:^|[^\p{L}\p{N}_''’])", r"(?:$|[^\p{L}\p{N}_''’])"
    tail = r"(?:[''’]s|e?s)?"
    find = lambda flags, body: f"nullif(lower(regexp_replace(regexp_extract({c}, '{flags}{edge}((?:{body}){tail}){end}', 1), '\\s+', ' ', 'g')), '')"
    return f"coalesce({find('', 'SECRET|HIV')}, {find('(?i)', r'drug\s+deal|surgeries|surgery|bomb')})"


@query("sensitive_matches", f"SELECT doc_id, {_sensitive_sql('text')} AS term FROM {sql_with(SENSITIVE)}")
def sensitive_matches(spark, d):
    return with_snippet(documents(spark, d), SENSITIVE).select("doc_id", rules.sensitive_match(F.col("text"), TERMS, ALLOW).alias("term"))


SPACES = ["", "\r\nx\r y", " a   b \n\n\n\nc", "x ​﻿y", "\n\n", "  z  \t"]
SQL_SPACES = "regexp_replace(regexp_replace(translate(regexp_replace(regexp_replace({c}, '\\r\\n', chr(10), 'g'), '\\r', chr(10), 'g'), chr(160) || chr(8199) || chr(8201) || chr(8239) || chr(8203) || chr(8204) || chr(8205) || chr(8288) || chr(65279), '    '), '[ \\t]+', ' ', 'g'), '(?m)^ | $', '', 'g')"


@query("whitespace_norm", f"SELECT doc_id, trim(regexp_replace({SQL_SPACES.replace('{c}', 'text')}, '\\n{{3,}}', chr(10) || chr(10), 'g'), chr(10)) AS text FROM {sql_with(SPACES)}")
def whitespace_norm(spark, d):
    return with_snippet(documents(spark, d), SPACES).select("doc_id", T.normalized_whitespace(F.col("text")).alias("text"))


GREETS = ["", "Dear all,\n", "Hi Ann,   ", "Dear dear dear dear dear,\n", "Hello,\n\n"]


@query("greeting_split", f"SELECT doc_id, regexp_replace(text, '^\\s*((?:\\S+ ){{0,3}}\\S+,)(?: {{2,}}|[ \\t]*\\n)', '\\1' || chr(10) || chr(10)) AS text FROM {sql_with(GREETS, True)}")
def greeting_split(spark, d):
    return with_snippet(documents(spark, d), GREETS, True).select("doc_id", T.greeting_header(F.col("text")).alias("text"))


@query("greeting_flatten", f"WITH t AS (SELECT doc_id, text, instr(text, chr(10) || chr(10)) AS i FROM {sql_with(GREETS, True)}) SELECT doc_id, CASE WHEN i > 0 AND regexp_full_match(substr(text, 1, i - 1), '(?:\\S+ ){{0,3}}\\S+,') THEN substr(text, 1, i - 1) || chr(10) || chr(10) || array_to_string({sql_words('substr(text, i + 2)')}, ' ') ELSE array_to_string({sql_words('text')}, ' ') END AS text FROM t")
def greeting_flatten(spark, d):
    return with_snippet(documents(spark, d), GREETS, True).select("doc_id", T.flattened_after_greeting(F.col("text")).alias("text"))


WRAPS = ["", "\na line without\nan end and\nMore.\nno", "\n\npara one\nis here.\n\nis two", "end.\"\nlower"]


def _sql_reflow() -> str:
    last = "string_split(acc, chr(10))[-1]"
    join = f"CASE WHEN NOT regexp_matches({last}, '[.!?:][\"''”’)\\]]*$') AND regexp_matches(x, '^\\p{{Ll}}') THEN acc || ' ' || x ELSE acc || chr(10) || x END"
    return f"SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10) || chr(10)), lambda p: list_reduce(string_split(p, chr(10)), lambda acc, x: {join})), chr(10) || chr(10)) AS text FROM {sql_with(WRAPS)}"


@query("reflow", _sql_reflow())
def reflow(spark, d):
    return with_snippet(documents(spark, d), WRAPS).select("doc_id", T.reflowed(F.col("text")).alias("text"))


BAD = ["", "�", "\x07", "\x85", "\tx"]


@query("bad_chars", f"SELECT doc_id, regexp_matches(text, '[\\x00-\\x09\\x0b-\\x1f\\x7f-\\x{{9f}}\\x{{fffd}}]') AS bad FROM {sql_with(BAD)}")
def bad_chars(spark, d):
    return with_snippet(documents(spark, d), BAD).select("doc_id", T.has_bad_characters(F.col("text")).alias("bad"))


OCR = ["", " ab-\ncd", " a1b", " 12a"]


@query("ocr_shapes", f"SELECT doc_id, CASE WHEN regexp_matches(text, '[\\p{{L}}\\p{{Nl}}\\p{{No}}]-\\n[\\p{{L}}\\p{{Nl}}\\p{{No}}]') THEN 'ocr_hyphen_break' WHEN regexp_matches(text, '[\\p{{L}}\\p{{Nl}}\\p{{No}}][0-9]+[\\p{{L}}\\p{{Nl}}\\p{{No}}]') THEN 'ocr_digit_in_word' END AS reason FROM {sql_with(OCR)}")
def ocr_shapes(spark, d):
    return with_snippet(documents(spark, d), OCR).select("doc_id", rules.ocr_shape_reason(F.col("text")).alias("reason"))


@query("signoff_lines", f"SELECT doc_id, {sql_signoff('text')} AS line, {sql_signoff('text')} IS NOT NULL AS has FROM documents")
def signoff_lines(spark, d):
    line = T.signoff_line(F.col("text"))
    return documents(spark, d).select("doc_id", line.alias("line"), line.isNotNull().alias("has"))


TOKENS = ["", " Straße don`t it’s", " A_B c"]
SQL_TOKENS = "list_sort(list_distinct(regexp_extract_all(replace(lower(translate(text, '’‘ʼ`´', '''''''''''')), 'ß', 'ss'), '[\\p{L}\\p{N}]+(?:''[\\p{L}\\p{N}]+)*')))"


@query("token_sets", f"SELECT doc_id, len({SQL_TOKENS})::BIGINT AS n, sha256(array_to_string({SQL_TOKENS}, ' ')) AS digest FROM {sql_with(TOKENS)}")
def token_sets(spark, d):
    t = T.token_set(F.col("text"))
    return with_snippet(documents(spark, d), TOKENS).select("doc_id", F.size(t).cast("long").alias("n"), F.sha2(F.array_join(t, " "), 256).alias("digest"))


DRAFT_FINISH = "CASE doc_id % 3 WHEN 0 THEN 'stop' WHEN 1 THEN 'length' END"


@query("draft_reasons", f"SELECT doc_id, CASE WHEN {DRAFT_FINISH} IS DISTINCT FROM 'stop' THEN 'truncated' WHEN doc_id % 2 = 0 AND {sql_signoff('text')} IS NULL THEN 'no_signoff' END AS reason FROM documents")
def draft_reasons(spark, d):
    return documents(spark, d).select("doc_id", rules.draft_reason(F.col("text"), F.expr(DRAFT_FINISH), F.expr("doc_id % 2 = 0")).alias("reason"))


ALL = [*WRAPPERS, *LENGTHS, *(x + " " for x in PII)]


@query("gate_reasons", f"SELECT doc_id, coalesce({sql_wrapper('text')}, {sql_known_error('text')}, {sql_length('text', None)}, 'pii_' || {sql_pii('text')}) AS reason FROM {sql_with(ALL, True)}")
def gate_reasons(spark, d):
    """The first failing rule of each text, cheap rules first."""
    c = F.col("text")
    return with_snippet(documents(spark, d), ALL, True).select("doc_id", F.coalesce(rules.wrapper_reason(c), rules.known_error_reason(c), rules.length_reason(c), F.concat(F.lit("pii_"), _pii(c))).alias("reason"))


@query("gate_reason_histogram", f"SELECT reason, count(*)::BIGINT AS n FROM (SELECT coalesce({sql_wrapper('text')}, {sql_known_error('text')}, {sql_length('text', None)}, 'pii_' || {sql_pii('text')}, 'kept') AS reason FROM {sql_with(ALL, True)}) GROUP BY reason")
def gate_reason_histogram(spark, d):
    return gate_reasons(spark, d).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


DUMPS = ["", "\n- a\n* b\n- c", "\n- a\n* b\n1. c", "\n• a\n• b\n• c", "\na | b | c | d", " x ```y", "\n# h", "\n####### h", "\n- a\n- b", "\r- a\r- b\x0b* c"]
_SQL_LINES = "string_split_regex(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]')"
#: A condition on text.
SQL_MARKDOWN = f"contains(text, '```') OR len(list_filter({_SQL_LINES}, lambda x: regexp_matches(x, '^\\s*[-*] '))) >= 3 OR len(list_filter({_SQL_LINES}, lambda x: regexp_matches(x, '^#+ ') OR length(x) - length(replace(x, '|', '')) >= 3)) > 0"


@query("markdown_dump", f"SELECT doc_id, {SQL_MARKDOWN} AS dump FROM {sql_with(DUMPS)}")
def markdown_dump(spark, d):
    return with_snippet(documents(spark, d), DUMPS).select("doc_id", rules.markdown_dump(F.col("text")).alias("dump"))


@query("bands", f"SELECT doc_id, n, CASE WHEN n < 60 THEN 'short' WHEN n < 180 THEN 'medium' ELSE 'long' END AS band, CASE WHEN n < 60 THEN 'short' WHEN n < 150 THEN 'medium' ELSE 'long' END AS name, n BETWEEN 20 AND 400 AS in_band FROM (SELECT doc_id, len({sql_words('text')})::BIGINT AS n FROM documents)")
def bands(spark, d):
    n = F.col("n")
    return documents(spark, d).select("doc_id", T.n_words(F.col("text")).alias("n")).select("doc_id", "n", T.band_of(n).alias("band"), T.band_name(n).alias("name"), n.between(*fixed.WORD_BAND).alias("in_band"))


@query("digests", "SELECT doc_id, sha256(text) AS sha256, substr(sha1(text), 1, 12) AS short, printf('rows-%s-%07d.json', substr(sha256(text), 1, 7), doc_id) AS page_key FROM documents")
def digests(spark, d):
    c = F.col("text")
    return documents(spark, d).select("doc_id", F.sha2(c, 256).alias("sha256"), F.substring(F.sha1(c), 1, 12).alias("short"), F.format_string("rows-%s-%07d.json", F.substring(F.sha2(c, 256), 1, 7), "doc_id").alias("page_key"))


@query("budgets", "SELECT doc_id, floor(length(text) / 3.5 * 1.5)::BIGINT + 32 AS budget, ceil(length(text) / 3.5)::BIGINT AS estimate, ceil(length(text) / 3.5) <= 1900 AS short_enough FROM documents")
def budgets(spark, d):
    c = F.col("text")
    return documents(spark, d).select("doc_id", T.generation_budget(c).alias("budget"), T.estimated_tokens(c).alias("estimate"), (T.estimated_tokens(c) <= fixed.TOKEN_LIMIT).alias("short_enough"))


@query("word_prefixes", f"SELECT doc_id, array_to_string(({sql_words('text')})[1:12], ' ') AS prefix, len({sql_words('text')})::BIGINT AS n FROM documents")
def word_prefixes(spark, d):
    w = T.words(F.col("text"))
    return documents(spark, d).select("doc_id", F.array_join(F.slice(w, 1, 12), " ").alias("prefix"), F.size(w).cast("long").alias("n"))


INSTRUCT = ["Fix grammar: ", "Fix the grammar mistakes: ", "Do this now: ", "", "Grammar improvements: "]


def _sql_prefix() -> str:
    known = " ".join(f"WHEN starts_with(text, {q(p)}) THEN {{'t': substr(text, {len(p) + 1}), 'how': 'known'}}" for p in fixed.PREFIXES)
    return f"SELECT doc_id, r.t AS body, r.how AS how FROM (SELECT doc_id, CASE {known} WHEN contains(text, ': ') THEN {{'t': substr(text, instr(text, ': ') + 2), 'how': 'fallback'}} ELSE {{'t': NULL, 'how': 'unparsed'}} END AS r FROM {sql_with(INSTRUCT, True)})"


@query("prefix_strip", _sql_prefix())
def prefix_strip(spark, d):
    return with_snippet(documents(spark, d), INSTRUCT, True).select("doc_id", T.prefix_stripped(F.col("text")).alias("r")).select("doc_id", F.col("r.text").alias("body"), F.col("r.how").alias("how"))


_PLAIN = sql_words("regexp_replace(text, '[^ -~]', '?', 'g')")


@query("levenshtein_tokens", f"SELECT doc_id, count(*) AS n, sum(levenshtein(w, v))::BIGINT AS d, sum(levenshtein(lower(w), lower(v)))::BIGINT AS folded FROM (SELECT doc_id, unnest(w[1:len(w) - 1]) AS w, unnest(w[2:]) AS v FROM (SELECT doc_id, {_PLAIN} AS w FROM documents) WHERE len(w) >= 2) GROUP BY doc_id")
def levenshtein_tokens(spark, d):
    """Neighbouring words of whole texts. Other than ASCII characters count as one question mark each: DuckDB measures bytes."""
    w = documents(spark, d).select("doc_id", T.words(F.regexp_replace("text", "[^ -~]", "?")).alias("w")).filter(F.size("w") >= 2)
    pair = F.explode(F.arrays_zip(F.slice("w", F.lit(1), F.size("w") - 1).alias("w"), F.slice("w", F.lit(2), F.size("w")).alias("v")))
    pairs = w.select("doc_id", pair.alias("p")).select("doc_id", F.col("p")["w"].alias("w"), F.col("p")["v"].alias("v"))
    return pairs.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.levenshtein("w", "v")).alias("d"), F.sum(F.levenshtein(F.lower("w"), F.lower("v"))).alias("folded"))


QUOTES = ["don't", "they’re", "it's", "plain"]


@query("apostrophe_fit", f"SELECT doc_id, CASE WHEN length(text) - length(replace(text, '’', '')) > length(text) - length(replace(text, '''', '')) THEN replace({sql_chosen(QUOTES)}, '''', '’') ELSE replace({sql_chosen(QUOTES)}, '’', '''') END AS fitted FROM (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN ' ’’’' ELSE ' ''' END AS text FROM documents)")
def apostrophe_fit(spark, d):
    from quern.plans.base import chosen

    docs = documents(spark, d).withColumn("text", F.concat("text", F.when(F.col("doc_id") % 3 == 0, " ’’’").otherwise(" '")))
    return docs.select("doc_id", T.apostrophe_fit(F.col("text"), chosen(QUOTES)).alias("fitted"))


@query("case_fit", f"SELECT doc_id, w, CASE WHEN length(regexp_replace(w, '[^\\p{{L}}]', '', 'g')) > 1 AND regexp_replace(w, '[^\\p{{L}}]', '', 'g') = upper(regexp_replace(w, '[^\\p{{L}}]', '', 'g')) THEN 'WORD' WHEN regexp_matches(w, '^\\p{{Lu}}') THEN 'Word' ELSE 'word' END AS fitted FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN upper(({sql_words('text')})[1]) ELSE ({sql_words('text')})[1 + doc_id % 3] END AS w FROM documents) WHERE w IS NOT NULL AND NOT contains(w, 'ß')")
def case_fit(spark, d):
    w = T.words(F.col("text"))
    own = F.when(F.col("doc_id") % 5 == 0, T.upper(F.try_element_at(w, F.lit(1)))).otherwise(F.try_element_at(w, (F.col("doc_id") % 3 + 1).cast("int")))
    return documents(spark, d).select("doc_id", own.alias("w")).filter("w IS NOT NULL AND NOT contains(w, 'ß')").select("doc_id", "w", T.one_word_case(F.col("w"), F.lit("word")).alias("fitted"))


ANSWERS = ["I am quernbot.", "I'm Quernbot, not ChatGPT or Gemini.", "I am Claude.", "quernbot, built on Qwen3.8", "not Qwen, Alibaba built quernbot", "As quernbot I love metadata and glamour", "nothing", "quern_bot isn’t GPT-4o; quernbot is"]


def _sql_identity() -> str:
    one = rf"(?:an? |the )?(?:{fixed.OTHER_NAMES}){fixed.VERSION}"
    denial = rf"\bnot[\s,-]+{one}(?:(?:\s*,\s*{one})*(?:\s*,\s*|\s+)(?:or|nor)\s+{one})*"
    t = f"lower(regexp_replace(replace(translate({sql_chosen(ANSWERS)}, '’‘ʼ`´', ''''''''''''), '_', ' '), '\\s+', ' ', 'g'))"
    return f"SELECT doc_id, a AS answer, contains(a, 'quernbot') AND NOT regexp_matches(regexp_replace(a, {q(denial)}, ' ', 'g'), {q(rf'\b(?:{fixed.OTHER_NAMES}){fixed.VERSION}')}) AS ok FROM (SELECT doc_id, {t} AS a FROM documents)"


@query("identity_answers", _sql_identity())
def identity_answers(spark, d):
    from quern.plans.base import chosen

    a = documents(spark, d, "doc_id").select("doc_id", chosen(ANSWERS).alias("a"))
    return a.select("doc_id", T.normalized_answer(F.col("a")).alias("answer"), T.identity_ok(F.col("a"), "quernbot").alias("ok"))


REPLIES = ["yes", "No.", "**Answer: yes**", "<think>hm</think> no", "<think>hm", "maybe", "Final verdict - No, because", "yesterday", " no !"]


def _sql_meaning(c: str) -> str:
    low = f"lower({c})"
    tail = f"CASE WHEN NOT contains({low}, '<think>') THEN {low} WHEN contains({low}, '</think>') THEN string_split({low}, '</think>')[-1] END"
    return "CASE regexp_extract(" + tail + ", " + q(r"""^[\s*_"'`#>]*(?:(?:final\s+)?(?:answer|verdict)\s*[:\-]\s*)?[\s*_"'`]*(yes|no)\b""") + ", 1) WHEN 'yes' THEN true WHEN 'no' THEN false END"


@query("verdicts", f"SELECT doc_id, {_sql_meaning('r')} AS meaning, coalesce(CASE trim(rtrim(trim(lower(r)), '.!?,;:')) WHEN 'no' THEN 'keep' WHEN 'yes' THEN 'reject' END, 'judge_unparseable') AS cleanliness FROM (SELECT doc_id, {sql_chosen(REPLIES)} AS r FROM documents)")
def verdicts(spark, d):
    from quern.plans.base import chosen

    r = documents(spark, d, "doc_id").select("doc_id", chosen(REPLIES).alias("r"))
    return r.select("doc_id", T.meaning_verdict(F.col("r")).alias("meaning"), T.cleanliness_verdict(F.col("r")).alias("cleanliness"))


@query("judge_prompts", f"SELECT doc_id, sha256({q(fixed.JUDGE_QUESTION)} || chr(10) || chr(10) || 'Text:' || chr(10) || '\"\"\"' || chr(10) || text || chr(10) || '\"\"\"' || chr(10) || chr(10) || 'Answer yes or no.') AS prompt, 'Continue this email:' || chr(10) || chr(10) || array_to_string(({sql_words('text')})[1:5], ' ') AS probe FROM documents")
def judge_prompts(spark, d):
    prompt = F.concat(F.lit(fixed.JUDGE_QUESTION + '\n\nText:\n"""\n'), F.col("text"), F.lit('\n"""\n\nAnswer yes or no.'))
    return documents(spark, d).select("doc_id", F.sha2(prompt, 256).alias("prompt"), F.concat(F.lit("Continue this email:\n\n"), F.array_join(F.slice(T.words(F.col("text")), 1, 5), " ")).alias("probe"))
