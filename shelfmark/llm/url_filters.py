"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over URLs: ``||`` at its start stands for the start of a host or of one of its
domains, ``*`` for anything, everything else for itself. A run of letters and digits that is
bounded on both sides, by the pattern's anchor or by a literal sign, is a whole token of every URL the
rule can fit. Of a rule's tokens the one that the fewest URLs of the table have is its key in the index;
a URL's tokens fetch the candidates, and only those run their regular expression. A rule without
a token is a candidate for every URL.

Rules come from the caller's memory, so their size is bounded by it; ``MAX_RULE_BYTES`` guards what is sent to
the tasks. How often tokens occur is counted over the whole table, for tokens of rules only.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field
from typing import Literal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULE_BYTES = 64 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TOKEN = re.compile("[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """A host rule (``||host/path``, named ``host/path``; the longest name wins) or a pattern."""

    action: Literal["allow", "block"]
    pattern: str
    name: str
    is_host: bool = field(default=False)

    def tokens(self) -> set[str]:
        """Whole tokens of every URL that the rule fits."""
        text = self.pattern.translate(_LOWER)
        anchored = text.startswith("||")
        body = text[2:] if anchored else text
        found = set()
        for match in _TOKEN.finditer(body):
            before, after = match.start(), match.end()
            left = anchored if before == 0 else body[before - 1] != "*"
            right = after < len(body) and body[after] != "*"
            if left and right:
                found.add(match[0])
        return found

    def expression(self) -> re.Pattern:
        """Over host and path for a host rule, over the lower-cased URL for a pattern."""
        body = self.pattern.removeprefix("||")
        text = ".*".join(map(re.escape, (body if self.is_host else body.translate(_LOWER)).split("*")))
        if not self.pattern.startswith("||"):
            return re.compile(text, re.DOTALL)
        return re.compile((r"(?:[^/]*\.)?" if self.is_host else r"[^:]*?://(?:[^/?#]*\.)?") + text, re.DOTALL)


_LOWER = str.maketrans(_UPPER, _UPPER.lower())


def host_rule(action: Literal["allow", "block"], host: str, path: str) -> Rule:
    return Rule(action, f"||{host}{path}", f"{host}{path}", is_host=True)


def pattern_rule(action: Literal["allow", "block"], pattern: str) -> Rule:
    return Rule(action, pattern, pattern)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A to Z lower-cased) and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(_LOWER), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def url_tokens(url: Column) -> Column:
    """Distinct runs of a to z and digits, A to Z lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.translate(url, _UPPER, _UPPER.lower()), F.lit("([a-z0-9]+)"), 1))


def token_counts(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """Of how many ``url`` values each token of a rule is one; one row for each such token reaches the driver."""
    wanted = sorted(set().union(*(rule.tokens() for rule in rules)))
    if not wanted:
        return {}
    tokens = urls.select(F.explode(F.array_intersect(url_tokens(F.col("url").cast("string")), F.lit(wanted))).alias("token"))
    return {row["token"]: row["count"] for row in tokens.groupBy("token").count().collect()}


class RuleIndex:
    """Rules by rarest token; ``judge`` runs only the candidates that a URL's tokens fetch."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]) -> None:
        self.by_token: dict[str, list[Rule]] = defaultdict(list)
        self.always: list[Rule] = []
        for rule in rules:
            tokens = rule.tokens()
            if tokens:
                self.by_token[min(tokens, key=lambda token: (counts.get(token, 0), token))].append(rule)
            else:
                self.always.append(rule)
        self.compiled: dict[Rule, re.Pattern] = {}

    def candidates(self, lowered: str) -> list[Rule]:
        fetched = [self.by_token[token] for token in set(_TOKEN.findall(lowered)) if token in self.by_token]
        return sum(fetched, list(self.always))

    def fits(self, rule: Rule, lowered: str, target: str) -> bool:
        found = self.compiled.get(rule)
        if found is None:
            found = self.compiled[rule] = rule.expression()
        if rule.is_host:
            return found.match(target) is not None
        return (found.match if rule.pattern.startswith("||") else found.search)(lowered) is not None

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, str | None, int]:
        """Host, path, host rule, verdict, pattern, and how many candidates ran."""
        host, path = split_url(url)
        lowered = (url or "").translate(_LOWER)
        candidates = self.candidates(lowered)
        fitting = [rule for rule in candidates if self.fits(rule, lowered, host + path)]
        hosts = [rule for rule in fitting if rule.is_host]
        if hosts:
            best = max(hosts, key=lambda rule: (len(rule.name), rule.action == "block", rule.name))
            return host, path, best.name, best.action, None, len(candidates)
        patterns = sorted((rule for rule in fitting if not rule.is_host), key=lambda rule: (rule.action != "allow", rule.name))
        if patterns:
            return host, path, None, patterns[0].action, patterns[0].name, len(candidates)
        return host, path, None, "allow", None, len(candidates)


_JUDGED = ["host", "path", "rule", "verdict", "pattern", "n_candidates"]


def filtered(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern, n_candidates`` for every row (``page_id, url``).

    The longest host rule that fits decides; of two equally long ones block holds. Without one an allowing pattern
    holds before a blocking one, and a URL that nothing fits is allowed. A null or empty url has an empty
    host and path and only rules without a token can fit it. Repeated rows each get their
    verdict, other columns are not read, and an empty table gives an empty result.
    """
    size = sum(len(rule.pattern) + len(rule.name) for rule in rules)
    if size > MAX_RULE_BYTES:
        raise ValueError(f"{size} bytes of rules; more than {MAX_RULE_BYTES} are not sent to every task")
    index = RuleIndex(rules, token_counts(pages, rules))
    sent = pages.sparkSession.sparkContext.broadcast(index)

    def judged(urls: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame([sent.value.judge(url) for url in urls], columns=_JUDGED, dtype=object)
        return found.astype({"n_candidates": "int32"})

    kind = "struct<host:string,path:string,rule:string,verdict:string,pattern:string,n_candidates:int>"
    verdicts = pages.select("page_id", F.pandas_udf(judged, kind)(F.col("url").cast("string")).alias("found"))
    return verdicts.select("page_id", *(f"found.{name}" for name in _JUDGED))
