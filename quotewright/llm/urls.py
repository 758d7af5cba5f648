"""URL filters: pattern rules found by their rarest literal token.

Rules are regular expressions over host and path. Each is filed under the one
of its literal tokens that the fewest URLs hold; the tokens of a URL fetch its
candidate rules, and only those run.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import LOWER, UPPER, lower_ascii, map_batches

TOKEN = re.compile(r"[a-z0-9]+")
ASCII_LOWER = str.maketrans(UPPER, LOWER)
ALLOW, BLOCK = "allow", "block"
# The signs of filter lists.
EXCEPTION, HOST_ANCHOR, END_ANCHOR, ANY = "@@", "||", "|", "*"
WILDCARDS = {ANY: ".*", "^": r"(?:[^a-z0-9_.%-]|\Z)"}
# The most rules read from a table, which bounds what the driver and each task hold.
MOST_RULES = 200_000


@dataclass(frozen=True)
class Rule:
    """A pattern over ``host + path``, the literal tokens any match holds, and its verdict."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    listed: bool = True  # a rule of the list; others only advise where no listed one fits
    exception: bool = False  # wins over every rule that is none, however long

    @property
    def rank(self) -> tuple[bool, int, str]:
        return self.exception, len(self.name), self.name


def tokens_of(text: str) -> list[str]:
    """Runs of ASCII letters and digits; no other letter becomes one of them."""
    return TOKEN.findall(text.translate(ASCII_LOWER))


def listed_rule(verdict: str, name: str) -> Rule:
    """A rule ``host/path``: the host with its subdomains, paths that start so.

    The last token of a path may go on in a URL, so it is no literal token.
    """
    host, _, path = name.partition("/")
    pattern = rf"(?:[^/]*\.)?{re.escape(host)}/{re.escape(path)}"
    whole = tokens_of(f"{host}/{path}|")
    if tokens_of(path[-1:]):
        whole = whole[:-1]
    return Rule(name, pattern, tuple(whole), verdict)


def filter_rule(line: str, listed: bool = False) -> Rule:
    """A rule of the usual form of filter lists.

    ``||`` begins at a label of the host, ``|`` ends the path, ``*`` is any
    text, ``^`` a separator or the end, ``@@`` before it all an exception.
    Letters count without case. A run of letters and digits is a literal token
    if the pattern bounds it at both ends; beside ``*``, or at an open end, a
    longer token of a URL could hold it.
    """
    body = line.removeprefix(EXCEPTION)
    anchored, closed = body.startswith(HOST_ANCHOR), body.endswith(END_ANCHOR)
    body = body.removeprefix(HOST_ANCHOR).removesuffix(END_ANCHOR).translate(ASCII_LOWER)
    pattern = "".join(WILDCARDS.get(char) or re.escape(char) for char in body)
    tokens = []
    for found in TOKEN.finditer(body):
        before, after = body[: found.start()][-1:], body[found.end() :][:1]
        bounded = (before != ANY if before else anchored) and (after != ANY if after else closed)
        if bounded:
            tokens.append(found[0])
    start, end = r"(?:[^/]*\.)?" if anchored else ".*", r"\Z" if closed else ""
    verdict = ALLOW if line.startswith(EXCEPTION) else BLOCK
    return Rule(line, f"(?ai){start}{pattern}{end}", tuple(tokens), verdict, listed, verdict == ALLOW)


def read_rules(lines: DataFrame, *, line_col: str = "line", most: int = MOST_RULES) -> tuple[Rule, ...]:
    """The distinct rules of a table of filter lines; empty lines and comments (``!``) are none.

    Rules go to the driver and to every task, so more than ``most`` are an error.
    """
    line = F.trim(F.col(line_col).cast("string"))
    rows = lines.select(line.alias("line")).filter("line <> '' AND line NOT LIKE '!%'").distinct()
    found = sorted(row["line"] for row in rows.limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"more than {most} rules")
    return tuple(map(filter_rule, found))


# The rules of the list.
RULES = (
    listed_rule(ALLOW, "org/"),
    listed_rule(BLOCK, "example.org/es/"),
    listed_rule(BLOCK, "example.org/en/1"),
    listed_rule(ALLOW, "com/fr/"),
    listed_rule(BLOCK, "com/de/"),
)

# What advises on the rest: hosts and paths that carry no prose worth training on.
ADVICE = (
    Rule("pills", r"[^/]*(?<![a-z0-9])cheap-pills(?![a-z0-9])", ("cheap", "pills"), BLOCK, False),
    Rule("casino", r"[^/]*(?<![a-z0-9])casino(?![a-z0-9])", ("casino",), BLOCK, False),
    Rule("login", r"[^/]*/(?:.*/)?login(?![A-Za-z0-9])", ("login",), BLOCK, False),
    Rule("cart", r"[^/]*/(?:.*/)?cart(?![A-Za-z0-9])", ("cart",), BLOCK, False),
)


def with_host_and_path(pages: DataFrame, url_col: str) -> DataFrame:
    """Add ``host`` and ``path``; both are empty for a null URL or one without ``://``."""
    url = F.col(url_col)
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    return (
        pages.withColumn("host", lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)))
        .withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))
        .fillna("", ["host", "path"])
    )


def token_counts(urls: DataFrame, rules: Iterable[Rule]) -> dict[str, int]:
    """In how many URLs each token of the rules stands, over all URLs."""
    spark = urls.sparkSession
    wanted = sorted({token for rule in rules for token in rule.tokens})
    if not wanted:
        return {}
    tokens = spark.createDataFrame([(token,) for token in wanted], "token string")
    found = F.array_distinct(F.split(lower_ascii(F.concat("host", "path")), "[^a-z0-9]+"))
    counted = urls.select(F.explode(found).alias("token")).groupBy("token").count()
    return {row["token"]: row["count"] for row in counted.join(tokens, "token").collect()}


def rule_index(rules: Iterable[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; those without a token are tried on every URL."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        rarest = min(rule.tokens, key=lambda token: (counts.get(token, 0), token), default="")
        index.setdefault(rarest, []).append(rule)
    return index


def candidate_rules(index: dict[str, list[Rule]], place: str) -> list[Rule]:
    """The rules that the tokens of ``host + path`` fetch."""
    return [rule for token in ("", *sorted(set(tokens_of(place)))) for rule in index.get(token, ())]


def judge_urls(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Iterable[Rule] = RULES + ADVICE,
) -> DataFrame:
    """Host, path, the longest listed rule that fits, and the verdict, for each page.

    The verdict is the listed rule's, else the longest-named advising rule's,
    else ``allow``; exceptions go before other rules, and equal lengths by name. Null URLs and URLs without
    ``://`` have an empty host and path and are allowed unless a rule without
    tokens fits. A rule's expression is compiled when a URL first fetches it. Repeated rows are judged alike; no rows give none; other
    columns are not looked at. The rules are a list in the driver, so the index
    that tasks get is as large as that list; URLs are never shuffled, only
    counts of the rules' own tokens.
    """
    rules = tuple(rules)
    urls = with_host_and_path(
        pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")), "url"
    ).select("page_id", "host", "path")
    index = rule_index(rules, token_counts(urls, rules))

    def start():
        compiled: dict[str, re.Pattern] = {}

        def one(place: str) -> tuple[str | None, str]:
            best: dict[bool, Rule] = {}
            for rule in candidate_rules(index, place):
                if rule.pattern not in compiled:
                    compiled[rule.pattern] = re.compile(rule.pattern, re.DOTALL)
                if compiled[rule.pattern].match(place):
                    if rule.listed not in best or rule.rank > best[rule.listed].rank:
                        best[rule.listed] = rule
            if True in best:
                return best[True].name, best[True].verdict
            return None, best[False].verdict if best else ALLOW

        def judge(batch: pa.RecordBatch) -> dict:
            hosts, paths = batch["host"].to_pylist(), batch["path"].to_pylist()
            found = [one(host + path) for host, path in zip(hosts, paths)]
            return {
                "page_id": batch["page_id"],
                "host": batch["host"],
                "path": batch["path"],
                "rule": [name for name, _ in found],
                "verdict": [verdict for _, verdict in found],
            }

        return judge

    schema = "page_id long, host string, path string, rule string, verdict string"
    return map_batches(urls, start, schema)
