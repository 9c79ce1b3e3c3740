"""URL filter over a sorted digest array (operator 2).

Rules are (verdict, host, path). Their 64-bit xxhash keys lie sorted in a memory-mapped array beside the stored full
strings. A URL is probed with one key for each host suffix and each path length that occurs among the rules; a batch's
keys go through one vectorised binary search, and a hit counts only when the stored strings are equal, so that a
collision of digests can't decide. The longest fitting rule wins, then the one with the longer host.

The rule index travels with the tasks only while it is within `most_index_bytes`. Beyond, rules are dealt into blocks
of at most that size; every URL is probed against each block, and the best hit over the blocks wins.

Defined results: a null URL or one without `://` has an empty host and path and no rule. Without a fitting rule the
verdict is `allow`: the filter blocks what a list names. Every row gives one row, repeated rows included; extra
columns are not read; an empty table gives an empty result. Rules with a null or empty host are refused.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import table

# The rules of the registered query.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
INDEX_BYTES = 64 << 20
SEPARATOR = "\x00"


def rule_key(host: str, path: str) -> str:
    return host + SEPARATOR + path


class DigestIndex:
    """Sorted digests in a mapped file, with the strings they stand for."""

    def __init__(self, rules: Iterable[tuple[str, str, str]], digest=xxhash.xxh64_intdigest):
        self.digest = digest
        found = {}
        for verdict, host, path in rules:
            if not host or path is None or verdict not in ("allow", "block"):
                raise ValueError(f"not a rule: {(verdict, host, path)}")
            key = rule_key(host, path)
            if found.setdefault(key, verdict) != verdict:
                raise ValueError(f"two verdicts for {host}{path}")
        rows = sorted((digest(k), k, v) for k, v in found.items())
        self.strings = [k for _, k, _ in rows]
        self.verdicts = [v for _, _, v in rows]
        self.path_lengths = sorted({len(k.partition(SEPARATOR)[2]) for k in self.strings})
        self.keys = mapped(np.array([d for d, _, _ in rows], np.uint64))

    def probe(self, strings: list[str]) -> np.ndarray:
        """The row of each string in the index, or -1."""
        out = np.full(len(strings), -1)
        if not len(self.keys) or not strings:
            return out
        digests = np.fromiter((self.digest(s) for s in strings), np.uint64, len(strings))
        at = np.searchsorted(self.keys, digests)
        hit = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == digests))
        for i in hit:
            j = at[i]
            while j < len(self.keys) and self.keys[j] == digests[i]:
                if self.strings[j] == strings[i]:
                    out[i] = j
                    break
                j += 1
        return out


def mapped(keys: np.ndarray) -> np.ndarray:
    """The keys in an unnamed file of this process, mapped read-only; it goes with the process."""
    if not len(keys):
        return keys
    with tempfile.TemporaryFile() as f:
        f.write(keys.tobytes())
        f.flush()
        return np.memmap(f, np.uint64, "r")


def host_suffixes(host: str) -> list[str]:
    out, at = [host], host.find(".")
    while at >= 0:
        out.append(host[at + 1 :])
        at = host.find(".", at + 1)
    return out


def judge(index: DigestIndex, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
    """Rule string and verdict of the longest fitting rule of each URL; None where none fits."""
    strings, owner = [], []
    for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        for suffix in host_suffixes(host) if host else ():
            for n in index.path_lengths:
                if n <= len(path):
                    strings.append(rule_key(suffix, path[:n]))
                    owner.append(i)
    rules: list[str | None] = [None] * len(hosts)
    verdicts: list[str | None] = [None] * len(hosts)
    best = [(-1, -1)] * len(hosts)
    rows = index.probe(strings)
    for k in np.flatnonzero(rows >= 0):
        i, j = owner[k], rows[k]
        host, _, path = index.strings[j].partition(SEPARATOR)
        if (rank := (len(host) + len(path), len(host))) > best[i]:
            best[i], rules[i], verdicts[i] = rank, host + path, index.verdicts[j]
    return rules, verdicts


def blocks_of(rules: Iterable[tuple[str, str, str]], most_bytes: int) -> Iterator[list[tuple[str, str, str]]]:
    block, size = [], 0
    for rule in rules:
        n = len(rule[1]) + len(rule[2]) + 64
        if block and size + n > most_bytes:
            yield block
            block, size = [], 0
        block.append(rule)
        size += n
    yield block


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", most_index_bytes: int = INDEX_BYTES) -> DataFrame:
    """id, host, path, rule and verdict of every row; see the module's docstring for the defined cases."""
    # the first `://` counts, later ones belong to the path or query
    after = F.expr(f"if(instr(`{url_col}`, '://') > 0, substring(`{url_col}`, instr(`{url_col}`, '://') + 3), '')")
    parts = pages.select(
        F.col(id_col),
        F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    kind = pages.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, host string, path string, rule string, verdict string"
    parts = parts.select("*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for block in blocks_of(rules, most_index_bytes):
        parts = parts.mapInArrow(_probing(block, id_col), schema)
    return parts.select(F.col(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))


def _probing(block: list[tuple[str, str, str]], id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestIndex(block)
        host_length = {h + p: len(h) for _, h, p in block}
        for batch in batches:
            hosts, paths, rules, verdicts = (batch.column(i).to_pylist() for i in (1, 2, 3, 4))
            new_rules, new_verdicts = judge(index, hosts, paths)
            for i, (rule, verdict) in enumerate(zip(new_rules, new_verdicts, strict=True)):
                if rule is not None and (rules[i] is None or longer(rule, rules[i], host_length)):
                    rules[i], verdicts[i] = rule, verdict
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=[id_col, "host", "path", "rule", "verdict"])

    return run


def longer(rule: str, other: str, host_length: dict[str, int]) -> bool:
    own = host_length.get(rule, rule.find("/"))
    return (len(rule), own) > (len(other), host_length.get(other, other.find("/")))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


OP2_SQL = """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(a, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS a FROM pages)
), ruled AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
