"""Verdicts on URLs from allow and block entries, by longest match in a trie.

The trie runs over the labels of the host from the last to the first and then over the segments
of the path. An entry fits its host and every subdomain of it, if the URL's path starts with the
entry's; of the entries that fit, the one with the most host labels and then the longest path
decides, and ``default`` where none fits.

The entries are a list in the driver, hence bounded by it; they are refused beyond ``MAX_ENTRIES``
and sent to every executor once, inside the function. URLs arrive in Arrow batches, rows are
independent, nothing is shuffled.

Defined cases: a null URL or one without ``://`` has an empty host and path and fits no entry;
very long URLs are read whole; an entry given twice with different verdicts is an error; empty
tables give empty results; other columns pass through untouched, and a clash with the names of
the results is an error.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F

MAX_ENTRIES = 1_000_000
UPPER_TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Entry:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


@dataclass
class Node:
    """``tails``: what remains of a path after its last whole segment, with the entry that ends there."""

    children: dict[str, Node] = field(default_factory=dict)
    paths: Node | None = None
    tails: dict[str, Entry] = field(default_factory=dict)


def build_trie(entries: Iterable[Entry]) -> Node:
    root, count = Node(), 0
    for entry in entries:
        count += 1
        if count > MAX_ENTRIES:
            raise ValueError(f"more than {MAX_ENTRIES} entries are too many to send to every executor")
        if entry.verdict not in ("allow", "block"):
            raise ValueError(f"verdict {entry.verdict!r} is neither allow nor block")
        node = root
        for label in reversed(entry.host.split(".")):
            node = node.children.setdefault(label, Node())
        node.paths = node.paths or Node()
        node = node.paths
        *segments, tail = entry.path.split("/")
        for segment in segments:
            node = node.children.setdefault(segment, Node())
        known = node.tails.setdefault(tail, entry)
        if known.verdict != entry.verdict:
            raise ValueError(f"{entry.name} is both allowed and blocked")
    return root


def longest_path(node: Node, path: str) -> Entry | None:
    """The entry below ``node`` with the longest path that ``path`` starts with."""
    found, at = None, 0
    while True:
        fits = [tail for tail in node.tails if path.startswith(tail, at)]
        if fits:
            found = node.tails[max(fits, key=len)]
        end = path.find("/", at)
        node = node.children.get(path[at:end]) if end >= 0 else None
        if node is None:
            return found
        at = end + 1


def longest_match(root: Node, host: str, path: str) -> Entry | None:
    found, node = None, root
    for label in reversed(host.split(".")):
        node = node.children.get(label)
        if node is None:
            break
        if node.paths:
            found = longest_path(node.paths, path) or found
    return found


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    for stop in "?#":
        rest = rest.partition(stop)[0]
    host, slash, path = rest.partition("/")
    return host.translate(UPPER_TO_LOWER), slash + path


RESULTS = ("host", "path", "rule", "verdict")


def judge_urls(pages: DataFrame, entries: Iterable[Entry], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, the deciding entry as ``rule`` (null if none) and ``verdict``."""
    root = build_trie(entries)
    clash = set(RESULTS) & set(pages.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")

    @F.pandas_udf("struct<host:string,path:string,rule:string,verdict:string>")
    def judged(urls: pd.Series) -> pd.DataFrame:
        rows = []
        for value in urls:
            host, path = host_and_path(value)
            entry = longest_match(root, host, path) if host else None
            rows.append((host, path, entry.name if entry else None, entry.verdict if entry else default))
        return pd.DataFrame(rows, columns=list(RESULTS), dtype="object")

    return pages.withColumn("_judged", judged(F.col(url))).select(
        *pages.columns, *[F.col(f"_judged.{c}").alias(c) for c in RESULTS]
    )
