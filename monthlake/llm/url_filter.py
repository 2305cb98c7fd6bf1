"""URL filter: pattern rules found through their rarest literal token.

Every rule names tokens (runs of ASCII letters and digits) that any url it matches must hold
whole. The rule is indexed under the one that the fewest urls of the table hold; a url's own
tokens then fetch its candidate rules, and only those run their regular expression. Rules
without a whole token are candidates of every url. Of matching prefix rules the longest wins; a
url that none fits gets the verdict of the first matching general pattern, else the default.

The rule list is a parameter held by the driver; the tables are never shuffled: token counts
aggregate partially to one row per indexed token, and judging is row-local.

Defined cases: a null url and one without ``://`` have an empty host and path, match no prefix
rule and get the default verdict; repeated rows are judged alike; null ids are kept; urls are
read whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.common import ship_code

TOKEN = "[A-Za-z0-9]+"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains and a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        return rf"(?:[^/]*\.)?{re.escape(self.host)}{re.escape(self.path)}"

    @property
    def tokens(self) -> list[str]:
        """Tokens that a matching url holds whole: the path's last one only if the prefix ends it."""
        path = re.findall(TOKEN, self.path)
        return re.findall(TOKEN, self.host) + (path[:-1] if re.search("[A-Za-z0-9]$", self.path) else path)


@dataclass(frozen=True)
class Pattern:
    """A general rule: ``word`` as a whole token anywhere in host or path."""

    verdict: str
    word: str

    @property
    def name(self) -> str:
        return self.word

    @property
    def pattern(self) -> str:
        return rf"(?s:.*)(?<![A-Za-z0-9]){re.escape(self.word)}(?![A-Za-z0-9])"

    @property
    def tokens(self) -> list[str]:
        return [self.word]


# The rules of the query.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))
PATTERNS = tuple(Pattern("block", w) for w in ("casino", "poker", "porn", "viagra", "xxx"))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    host = re.match("[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match("[^?#]*", rest[len(host):])[0]


def token_counts(urls: DataFrame, wanted: Sequence[str]) -> dict[str, int]:
    """How many urls hold each wanted token (at most one row per wanted token comes back)."""
    tokens = F.array_distinct(F.regexp_extract_all(F.col("url"), F.lit(TOKEN), F.lit(0)))
    t = urls.select(F.explode(tokens).alias("token")).where(F.col("token").isin(list(wanted)))
    return {r.token: r["count"] for r in t.groupBy("token").count().collect()}


def build_index(rules: Sequence, counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rarest token to rule numbers; and the rules that have no whole token."""
    index: dict[str, list[int]] = {}
    always: list[int] = []
    for n, rule in enumerate(rules):
        if rule.tokens:
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
            index.setdefault(rarest, []).append(n)
        else:
            always.append(n)
    return index, always


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, patterns: Sequence[Pattern] = PATTERNS,
                default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` per page."""
    ship_code(pages.sparkSession)
    p = pages.select("page_id", "url")
    every = [*rules, *patterns]
    index, always = build_index(every, token_counts(p, sorted({t for r in every for t in r.tokens})))
    n_rules = len(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [re.compile(r.pattern) for r in every]
        token = re.compile(TOKEN)

        def judge(url: str | None) -> tuple:
            host, path = split_url(url)
            where = host + path
            found = [n for t in set(token.findall(where)) for n in index.get(t, ())]
            fits = [n for n in (*found, *always) if compiled[n].match(where)]
            if own := [n for n in fits if n < n_rules]:
                best = min(own, key=lambda n: (-len(every[n].name), every[n].name, n))
                return host, path, every[best].name, every[best].verdict, None
            if fits:
                best = every[min(fits)]
                return host, path, None, best.verdict, best.name
            return host, path, None, default, None

        for b in batches:
            rows = [judge(u.as_py()) for u in b.column(1)]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(c), pa.string()) for c in columns)],
                                             ["page_id", "host", "path", "rule", "verdict", "pattern"])

    return p.mapInArrow(run, f"page_id {dict(p.dtypes)['page_id']}, host string, path string, rule string, "
                             "verdict string, pattern string")
