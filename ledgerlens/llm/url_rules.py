"""URL verdicts by pattern rules that are indexed by their rarest literal token.

A token is a maximal run of a-z and 0-9. A rule can only fit a url that has every token
which its pattern surrounds on both sides by other characters or by an anchor; of those
tokens the rule is filed under the one that the fewest urls have. A url fetches the rules
filed under its own tokens, and only those run their regular expression; rules without a
whole token (`*track`) are few and run on every url. How often a token occurs is counted
over all urls, for the tokens of rules alone; it decides the cost and never a verdict.

Pattern syntax: `*` is any run of characters, `^` a separator (none of a-z 0-9 _ - . %) or
the end, `|` at an end is that end, `||` in front is the start or the place after a dot.
All else is literal; A-Z count as a-z.

Address rules (host, path) are rules of the same index: one fits its host and all
subdomains, if the url's path starts with the rule's, letter by letter; with an empty path
it fits every path. The longest that fits decides (of equal texts: allow). Without one, the
pattern rules do: an allowing pattern that fits, then a blocking one, then the default.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
HOST, URL, ADDRESS = "host", "url", "address"
#: Rules are broadcast, so their number and length are bounded.
MOST_RULES, MOST_CHARS = 1 << 18, 1 << 12
TOKEN = re.compile("[a-z0-9]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """`part` is what the regular expression sees: the host, the whole url, or host + path."""

    text: str
    verdict: str
    part: str
    regex: str
    tokens: tuple[str, ...]


def _checked(text: str, verdict: str) -> None:
    if verdict not in (ALLOW, BLOCK):
        raise ValueError(f"rule {text!r} has the verdict {verdict!r}")
    if len(text) > MOST_CHARS:
        raise ValueError(f"rule of {len(text)} characters; at most {MOST_CHARS}")


def address_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule on a host, its subdomains, and the beginning of the path."""
    host = host.translate(LOWER)
    _checked(host + path, verdict)
    if not host or path and not path.startswith("/"):
        raise ValueError(f"address rule of host {host!r} and path {path!r}")
    whole = path.translate(LOWER)
    # The last run of the path may go on in the url.
    tokens = TOKEN.findall(host) + TOKEN.findall(re.sub("[a-z0-9]+$", "", whole))
    regex = rf"\A(?:[^/]*\.)?{re.escape(host)}" + (re.escape(path) if path else r"(?=/|\Z)")
    return Rule(host + path, verdict, ADDRESS, regex, tuple(dict.fromkeys(tokens)))


def pattern_rule(text: str, verdict: str = BLOCK, part: str = URL) -> Rule:
    _checked(text, verdict)
    if part not in (HOST, URL):
        raise ValueError(f"pattern rule on {part!r}")
    body = text.translate(LOWER)
    label = body.startswith("||")
    start = body.startswith("|") and not label
    body = body[2 if label else 1 if start else 0 :]
    end = body.endswith("|")
    body = body[:-1] if end else body
    tokens = []
    for m in TOKEN.finditer(body):
        left = label or start if m.start() == 0 else body[m.start() - 1] != "*"
        right = end if m.end() == len(body) else body[m.end()] != "*"
        if left and right:
            tokens.append(m[0])
    made = "".join(".*" if c == "*" else r"(?:[^a-z0-9_\-.%]|\Z)" if c == "^" else re.escape(c) for c in body)
    # In a url the host begins after the scheme.
    lead = r"(?:\A|://|\.)" if label else r"\A" if start else ""
    return Rule(text, verdict, part, lead + made + (r"\Z" if end else ""), tuple(dict.fromkeys(tokens)))


def address(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path; both empty without a "://"."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = re.split("[?#]", url[at + 3 :], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(LOWER), slash + path


def token_counts(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """How many urls have each token of the rules; at most one row per token comes back."""
    known = sorted({t for r in rules for t in r.tokens})
    vocabulary = urls.sparkSession.createDataFrame([(t,) for t in known], "token string")
    found = urls.select(F.explode(F.array_distinct(F.split(F.lower("url"), "[^a-z0-9]+"))).alias("token"))
    counts = found.join(F.broadcast(vocabulary), "token").groupBy("token").count()
    return {r["token"]: r["count"] for r in counts.collect()}


class Index:
    """Rules by their rarest token."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int] | None = None):
        if len(rules) > MOST_RULES:
            raise ValueError(f"{len(rules)} rules; at most {MOST_RULES}")
        counts = counts or {}
        self.rules = list(rules)
        self.filed: dict[str, list[int]] = {}
        self.everywhere: list[int] = []
        for i, rule in enumerate(self.rules):
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), len(self.filed.get(t, ())), -len(t), t))
                self.filed.setdefault(rarest, []).append(i)
            else:
                self.everywhere.append(i)
        self._compiled: dict[int, re.Pattern] = {}

    def __getstate__(self):
        return self.__dict__ | {"_compiled": {}}

    def candidates(self, lowered: str) -> list[int]:
        """Rules that may fit a url with A-Z lower-cased."""
        found = list(self.everywhere)
        for token in dict.fromkeys(TOKEN.findall(lowered)):
            found += self.filed.get(token, ())
        return found

    def _fits(self, i: int, text: str) -> bool:
        pattern = self._compiled.get(i)
        if pattern is None:  # only rules that are fetched at all are compiled
            pattern = self._compiled[i] = re.compile(self.rules[i].regex, re.DOTALL)
        return pattern.search(text) is not None

    def judge(self, url: str | None, default: str = ALLOW) -> tuple[str, str, str | None, str]:
        """Host, path, the address rule that decides (or None), verdict."""
        host, path = address(url)
        if url is None:
            return host, path, None, default
        lowered = url.translate(LOWER)
        seen = {HOST: host, URL: lowered, ADDRESS: host + path}
        best, patterns = None, set()
        for i in self.candidates(lowered):
            rule = self.rules[i]
            if rule.part == ADDRESS:
                rank = (len(rule.text), rule.verdict == ALLOW)
                if (best is None or rank > best[0]) and self._fits(i, seen[ADDRESS]):
                    best = rank, rule
            elif rule.verdict not in patterns and self._fits(i, seen[rule.part]):
                patterns.add(rule.verdict)
        if best:
            return host, path, best[1].text, best[1].verdict
        return host, path, None, ALLOW if ALLOW in patterns else BLOCK if BLOCK in patterns else default


def judge_urls(
    pages: DataFrame, addresses: Iterable[tuple[str, str, str]], patterns: Iterable[Rule], default: str = ALLOW
) -> DataFrame:
    """page_id, url, host, path, rule, verdict of every row; one pass without a shuffle.

    `addresses` are (verdict, host, path). A null url, or one without "://", has an empty
    host and path, so no address rule fits; patterns on the url see the latter as it is, a
    null gets the default. Repeated rows are judged alike, long urls whole; other columns,
    whatever their names, are ignored, and an empty table gives an empty result.
    """
    rules = [address_rule(host, path, verdict) for verdict, host, path in addresses] + list(patterns)
    urls = pages.select("page_id", "url")
    index = pages.sparkSession.sparkContext.broadcast(Index(rules, token_counts(urls, rules)))

    def judged(batches):
        for batch in batches:
            rows = [index.value.judge(u, default) for u in batch.column(1).to_pylist()]
            made = [pa.array([r[k] for r in rows], pa.string()) for k in range(4)]
            yield pa.record_batch([batch.column(0), batch.column(1), *made], ["page_id", "url", "host", "path", "rule", "verdict"])

    return urls.mapInArrow(judged, "page_id long, url string, host string, path string, rule string, verdict string")


#: The query's rules; fixed values.
ADDRESSES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
#: Kinds of sites that a training corpus leaves out, by parts of host names; fixed values.
UNWANTED_HOSTS = ("||adult-", "||ads-", "||casino-", "||spam-", "-bets.", "-pills.")
UNWANTED = tuple(pattern_rule(p, BLOCK, HOST) for p in UNWANTED_HOSTS)
