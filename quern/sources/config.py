"""Categories, writers and sources from TOML files, read and checked on the driver."""

from __future__ import annotations

import math
import tomllib

from pyspark.sql import DataFrame, SparkSession

from quern.functions import fixed

_SOURCE_KEYS = {"name": str, "adapter": str, "license": str, "heldout": int, "seeds": int, "hard_cap": int, "category": str, "max_chars": int, "reflow": bool, "ocr": bool, "oversample": float}


def categories(spark: SparkSession, toml: str) -> DataFrame:
    """(id, name, describe, lengths, has_signoff, examples); ids are unique and shares cover the bands and sum to one."""
    rows, seen = tomllib.loads(toml).get("category", []), set()
    for r in rows:
        if r["id"] in seen:
            raise ValueError(f"category {r['id']} stands twice")
        seen.add(r["id"])
        if set(r["lengths"]) != set(fixed.BANDS) or not math.isclose(sum(r["lengths"].values()), 1, abs_tol=1e-9):
            raise ValueError(f"category {r['id']}: shares have to cover the bands and sum to one")
    data = [(r["id"], r.get("name"), r.get("describe"), {k: float(v) for k, v in r["lengths"].items()}, bool(r.get("has_signoff")), list(r.get("examples", []))) for r in rows]
    return spark.createDataFrame(data, "id string, name string, describe string, lengths map<string,double>, has_signoff boolean, examples array<string>")


def writers(toml: str) -> list[dict]:
    """Writers by name; kind is openai, which needs a base_url, or import."""
    out = []
    for name, r in sorted(tomllib.loads(toml).get("writer", {}).items()):
        if r.get("kind") not in ("openai", "import"):
            raise ValueError(f"writer {name}: unknown kind")
        if r["kind"] == "openai" and not r.get("base_url"):
            raise ValueError(f"writer {name}: no base_url")
        out.append({"name": name, **r})
    return out


def judge(toml: str) -> dict:
    """The judge: base_url and model are needed; max_tokens and disable_thinking have defaults. It is a table of its own, so it is never among the writers."""
    own = tomllib.loads(toml).get("judge", {})
    if missing := [k for k in ("base_url", "model") if not own.get(k)]:
        raise ValueError(f"judge: no {missing[0]}")
    return {"max_tokens": 8, "disable_thinking": True} | own


def sources(spark: SparkSession, toml: str) -> DataFrame:
    """A row a source, by name; keys of its adapter's own go to options."""
    data = []
    for name, r in sorted(tomllib.loads(toml).get("source", {}).items()):
        r = {"name": name, **r}
        data.append((*[kind(r[k]) if k in r else None for k, kind in _SOURCE_KEYS.items()], {k: str(v) for k, v in r.items() if k not in _SOURCE_KEYS}))
    kinds = {str: "string", int: "long", bool: "boolean", float: "double"}
    return spark.createDataFrame(data, ", ".join(f"{k} {kinds[t]}" for k, t in _SOURCE_KEYS.items()) + ", options map<string,string>")


def over_request(target: int) -> int:
    """Drafts to ask for."""
    return math.ceil(1.25 * target)


def candidates(seeds: int, heldout: int, oversample: float) -> tuple[int, int]:
    """Held-out and seed candidates to read."""
    return heldout + 2, math.ceil(oversample * seeds)


def license_of(licenses: dict[str, str], source: str) -> str:
    """A source's licence; a source without one is an error."""
    if not licenses.get(source):
        raise LookupError(f"no licence is recorded for {source}")
    return licenses[source]
