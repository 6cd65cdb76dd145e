"""Fetches that are kept: whole bodies, absent addresses, sizes and records of remote files, in a folder that all machines share."""

from __future__ import annotations

import hashlib
import os
import urllib.robotparser
import uuid

from quern.sources.web import Reply, Session, Stopped, record_at


class Store:
    """Files by key; each is whole or not there, as it is written beside its place and then moved."""

    def __init__(self, folder: str) -> None:
        self.folder = folder.removeprefix("file://")

    def _path(self, key: str) -> str:
        return os.path.join(self.folder, key.replace("/", "_"))

    def get(self, key: str) -> bytes | None:
        try:
            with open(self._path(key), "rb") as f:
                return f.read()
        except FileNotFoundError:
            return None

    def put(self, key: str, body: bytes) -> None:
        os.makedirs(self.folder, exist_ok=True)
        beside = f"{self._path(key)}.{uuid.uuid4().hex}"
        with open(beside, "wb") as f:
            f.write(body)
        os.replace(beside, self._path(key))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:16]


class Fetcher:
    """A session's requests, each sent only if its result isn't stored; network counts those sent."""

    def __init__(self, session: Session, store: Store | None = None) -> None:
        self.session, self.store, self.network = session, store, 0

    def _kept(self, key: str) -> bytes | None:
        return None if self.store is None else self.store.get(key)

    def _keep(self, key: str, body: bytes) -> None:
        if self.store is not None:
            self.store.put(key, body)

    def get(self, url: str, key: str, absent: tuple[int, ...] = (404,), most: int = 64 << 20) -> bytes | None:
        """The body, stored or from one request; None for an absent address, which is remembered too."""
        if (body := self._kept(key)) is not None:
            return body
        if self._kept(f"{key}.absent") is not None:
            return None
        reply = self.session.request(url, absent=absent, most=most)
        self.network += 1
        if reply.status in absent:
            self._keep(f"{key}.absent", b"")
            return None
        self._keep(key, reply.body)
        return reply.body

    def _partial(self, url: str, first: int, last: int) -> Reply:
        self.network += 1
        reply = self.session.request(url, absent=(), headers={"Range": f"bytes={first}-{last}"}, most=last - first + 1025)
        if reply.status != 206:
            raise Stopped(f"status {reply.status} where part of a file was asked for")
        return reply

    def part(self, url: str, start: int, end: int) -> bytes:
        """Bytes start to end, end not included, of a remote file; only a partial reply counts."""
        return self._partial(url, start, end - 1).body

    def size(self, url: str) -> int:
        """A remote file's size, from the reply to a request for its first byte."""
        key = f"size-{_digest(url)}"
        if (known := self._kept(key)) is not None:
            return int(known)
        said = self._partial(url, 0, 0).headers.get("content-range", "")
        if not said.rpartition("/")[2].isdigit():
            raise Stopped("a partial reply doesn't name the file's size")
        self._keep(key, said.rpartition("/")[2].encode())
        return int(said.rpartition("/")[2])

    def record(self, url: str, offset: int) -> bytes | None:
        """The first whole line that starts after offset of a remote file of lines (at it for zero), stored by offset; None at the end."""
        key = f"record-{_digest(url)}-{offset:012d}"
        if (known := self._kept(key)) is not None:
            return known[1:] if known[:1] == b"+" else None
        found = record_at(lambda a, b: self.part(url, a, b), self.size(url), offset)
        self._keep(key, b"-" if found is None else b"+" + found)
        return found

    def robots(self, site: str) -> urllib.robotparser.RobotFileParser:
        """A site's rules for robots; a missing file allows all."""
        parser = urllib.robotparser.RobotFileParser()
        parser.parse((self.get(f"{site.rstrip('/')}/robots.txt", f"robots-{_digest(site)}") or b"").decode("utf-8", "replace").splitlines())
        return parser
