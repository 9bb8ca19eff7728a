"""URL filter: host and path rules first, then a weighted vocabulary searched by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

# The default vocabulary. One strict term rejects, soft terms by their summed weight.
STRICT = ("porn", "pornhub", "xvideos", "xxx", "hentai", "camgirl", "camgirls", "escort", "escorts", "milf", "onlyfans")
SOFT = {
    "adult": 1,
    "bet": 1,
    "betting": 1,
    "bonus": 1,
    "casino": 1,
    "cheap": 1,
    "dating": 1,
    "discount": 1,
    "free": 1,
    "jackpot": 1,
    "loan": 1,
    "loans": 1,
    "nude": 1,
    "pharmacy": 1,
    "pills": 1,
    "poker": 1,
    "replica": 1,
    "sex": 1,
    "sexy": 1,
    "slots": 1,
    "torrent": 1,
    "viagra": 1,
    "warez": 1,
}
# The rules of the registered query.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@dataclass(frozen=True)
class Vocabulary:
    """Terms are ASCII words in lower case; a hit must not touch an ASCII letter or digit on either side."""

    strict: tuple[str, ...] = STRICT
    soft: dict[str, int] = field(default_factory=lambda: dict(SOFT))
    soft_limit: int = 2


class Filter:
    """The compiled vocabulary and rules."""

    def __init__(self, vocabulary: Vocabulary, rules: tuple[tuple[str, str, str], ...]):
        self.vocabulary = vocabulary
        self.machine = ahocorasick.Automaton()
        for term in {*vocabulary.strict, *vocabulary.soft}:
            self.machine.add_word(term, term)
        if len(self.machine):
            self.machine.make_automaton()
        self.strict = frozenset(vocabulary.strict)
        self.rules: dict[str, list[tuple[str, str]]] = {}
        for verdict, host, path in rules:
            self.rules.setdefault(host, []).append((path, verdict))

    def terms(self, url: str) -> set[str]:
        """Distinct vocabulary terms of a lower-case URL."""
        if not len(self.machine):
            return set()
        found = set()
        for last, term in self.machine.iter(url):
            first = last - len(term)
            before = url[first] if first >= 0 else ""
            after = url[last + 1] if last + 1 < len(url) else ""
            if not (before.isascii() and before.isalnum() or after.isascii() and after.isalnum()):
                found.add(term)
        return found

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        """Text and verdict of the longest rule that fits; of equally long ones that with the longer host."""
        best: tuple[int, int, str, str] | None = None
        labels = host.split(".")
        for i in range(len(labels)):
            name = ".".join(labels[i:])
            for start, verdict in self.rules.get(name, ()):
                if path.startswith(start):
                    now = (len(name) + len(start), len(name), name + start, verdict)
                    best = max(best, now) if best else now
        return best[2:] if best else None

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, int, int]:
        """Host, path, rule, verdict, number of strict terms and weight of soft terms."""
        host, path = split(url)
        lower = (url or "").translate(LOWER)
        found = self.terms(lower)
        strict = len(found & self.strict)
        soft = sum(self.vocabulary.soft.get(term, 0) for term in found - self.strict)
        rule = self.rule(host, path)
        if rule:
            return host, path, rule[0], rule[1], strict, soft
        verdict = "block" if strict or soft >= self.vocabulary.soft_limit else "allow"
        return host, path, None, verdict, strict, soft


def split(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path of a URL; both empty without `://`."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min((i for i in (rest.find("/"), rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    host, path = rest[:at].translate(LOWER), rest[at:]
    at = min((i for i in (path.find("?"), path.find("#")) if i >= 0), default=len(path))
    return host, path[:at]


def judge(pages: DataFrame, vocabulary: Vocabulary | None = None, rules=(), column: str = "url") -> DataFrame:
    """Adds host, path, rule, verdict, strict_hits and soft_weight to every row.

    A null URL counts as empty: no host, no path, no rule, allowed. Every input column is kept; one named
    like an added column is replaced. Repeated rows get equal results.
    """
    vocabulary = vocabulary or Vocabulary()
    added = ["host", "path", "rule", "verdict", "strict_hits", "soft_weight"]
    kept = [name for name in pages.columns if name not in added]
    source = pages.select(*[f"`{name}`" for name in kept])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]
    fields += ["host string", "path string", "rule string", "verdict string", "strict_hits bigint", "soft_weight bigint"]
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Filter(vocabulary, tuple(rules))
        for batch in batches:
            judged = [compiled.judge(url) for url in batch.column(column).to_pylist()]
            columns = [pa.array([row[i] for row in judged], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=kept + added)

    return source.mapInArrow(rows, ", ".join(fields))


def oracle_sql(vocabulary: Vocabulary | None = None, rules=RULES) -> str:
    """The registered query in DuckDB SQL."""
    vocabulary = vocabulary or Vocabulary()
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hit = "regexp_matches(low, '(^|[^a-z0-9]){}([^a-z0-9]|$)')"
    strict = " + ".join(f"{hit.format(term)}::bigint" for term in vocabulary.strict)
    soft = " + ".join(f"{weight} * {hit.format(term)}::bigint" for term, weight in vocabulary.soft.items())
    names = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in rules)
    return f"""
    with rules(verdict, host, path) as (values {names}),
    cut as (
      select page_id, coalesce(url, '') as url, translate(coalesce(url, ''), '{upper}', '{lower}') as low,
        case when contains(url, '://') then substr(url, position('://' in url) + 3) else '' end as rest
      from pages),
    parts as (
      select *, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') as host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
      from cut),
    hits as (select *, {strict} as strict_hits, {soft} as soft_weight from parts),
    best as (
      select p.page_id, arg_max(r.host || r.path, length(r.host || r.path) * 1000 + length(r.host)) as rule,
        arg_max(r.verdict, length(r.host || r.path) * 1000 + length(r.host)) as verdict
      from parts p join rules r
        on (p.host = r.host or suffix(p.host, '.' || r.host)) and starts_with(p.path, r.path)
      group by p.page_id)
    select h.page_id, h.host, h.path, b.rule,
      coalesce(b.verdict, case when strict_hits > 0 or soft_weight >= {vocabulary.soft_limit} then 'block' else 'allow' end) as verdict,
      strict_hits, soft_weight
    from hits h left join best b using (page_id)"""
