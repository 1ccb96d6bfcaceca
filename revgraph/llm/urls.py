"""URL filters: rules indexed by their rarest literal token.

Two kinds of rules. A host rule (host, path) fits the host itself and all its
subdomains where the path begins with the rule's; of those that fit, the longest
decides. A pattern rule is text to be found anywhere in the URL, in lower case:
``*`` stands for anything, ``^`` for a separator or the end, ``||`` in front for
the start of the host or of a label of it, ``|`` for the start or end. Where no
host rule fits, a URL that a blocking pattern meets is blocked unless an allowing
pattern meets it too; the rest is allowed.

Every rule becomes a regular expression and is filed once, under that of its
literal tokens that the fewest URLs of the table hold (a token is a run of
``a-z0-9``, literal if the rule fixes both its ends). A URL fetches the rules
filed under its own tokens, and only those run their expressions; rules without
a literal token are tried on every URL. Fetching by tokens loses no rule, as a
rule can only fit a URL that holds all its literal tokens.

The rules are a list of the driver of at most ``MOST_RULES``, more are refused;
they are sent to the workers with the code. URLs are never shuffled: counting
tokens sums a few numbers per task, and each row is judged where it lies.

Defined results: a null URL, and one without ``://``, has an empty host and path
and no host rule, and patterns are tried on what text there is; rows are judged
one by one, repeated rows alike; rules of one length: the first stated; a URL may
be of any length; an empty table gives no rows; only the id and the URL are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_RULES = 100_000
ALLOW, BLOCK = "allow", "block"
TOKEN = re.compile("[0-9a-z]+")
_ASCII = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str = ""

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    verdict: str
    pattern: str


#: Host rules: allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/.
HOST_RULES = [
    HostRule(ALLOW, "org", "/"),
    HostRule(BLOCK, "example.org", "/es/"),
    HostRule(BLOCK, "example.org", "/en/1"),
    HostRule(ALLOW, "com", "/fr/"),
    HostRule(BLOCK, "com", "/de/"),
]

#: Sites that sell pills, bets or sex, by the words of their host names; adverts and trackers by their paths.
PATTERN_RULES = [
    *[PatternRule(BLOCK, f"||{words}") for words in ("cheap-pills.", "*-pills.", "*-casino.", "casino.", "*-poker.", "poker.", "viagra.", "porn.", "xxx.", "ads.", "adserver.", "doubleclick.")],
    *[PatternRule(BLOCK, f"/{path}^") for path in ("adclick", "banners/click", "affiliate/redirect")],
    PatternRule(ALLOW, "||*.edu/"),
]


def split_url(url: str | None) -> tuple[str, str]:
    """Host, with A-Z in lower case, and path of a URL."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = re.split("[?#]", url[at + 3 :], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_ASCII), slash + path


def _literal(text: str, open_start: bool, open_end: bool) -> set[str]:
    """Whole tokens of a fixed text, which may be continued at its open ends."""
    found = set()
    for m in TOKEN.finditer(text):
        if not (open_start and m.start() == 0) and not (open_end and m.end() == len(text)):
            found.add(m.group())
    return found


def compile_host(rule: HostRule) -> tuple[re.Pattern, set[str]]:
    """An expression over host and path in one text, and the rule's literal tokens."""
    host, path = rule.host.translate(_ASCII), rule.path
    front = r"(?:[^/]*\.)?" + re.escape(host) if host else "[^/]*"
    tokens = _literal(host, False, False) | _literal(path.translate(_ASCII), True, True)
    return re.compile(front + r"(?=/|\Z)" + re.escape(path), re.DOTALL), tokens


def compile_pattern(rule: PatternRule) -> tuple[re.Pattern, set[str]]:
    """An expression to be searched in the whole URL, and the rule's literal tokens."""
    text, front, back = rule.pattern.translate(_ASCII), "", ""
    if text.startswith("||"):
        text, front = text[2:], r"\A[a-z][a-z0-9+.\-]*://(?:[^/?#]*\.)?"
    elif text.startswith("|"):
        text, front = text[1:], r"\A"
    if text.endswith("|"):
        text, back = text[:-1], r"\Z"
    tokens: set[str] = set()
    # A token counts as literal if something other than a star ends it on either side.
    parts = text.split("*")
    for i, part in enumerate(parts):
        tokens |= _literal(part, i > 0 or not front, i < len(parts) - 1 or not back)
    body = "".join({"*": ".*", "^": r"(?:[^a-z0-9_.%\-]|\Z)"}.get(c) or re.escape(c) for c in text)
    if front.endswith(")?"):  # within the host as far as the rule's first stars go
        body = re.sub(r"\A(?:\.\*)+", "[^/?#]*", body)
    return re.compile(front + body + back, re.DOTALL), tokens


class Index:
    """Rules by their rarest literal token; ``runs`` counts expressions tried."""

    def __init__(self, hosts: list[HostRule], patterns: list[PatternRule], seen: Counter | None = None):
        if len(hosts) + len(patterns) > MOST_RULES:
            raise ValueError(f"{len(hosts) + len(patterns)} rules are more than {MOST_RULES}")
        seen = seen or Counter()
        self.rules = [(*compile_host(r), r) for r in hosts] + [(*compile_pattern(r), r) for r in patterns]
        self.by_token: dict[str, list[int]] = {}
        self.every: list[int] = []
        for i, (_, tokens, _) in enumerate(self.rules):
            if tokens:
                self.by_token.setdefault(min(tokens, key=lambda t: (seen[t], -len(t), t)), []).append(i)
            else:
                self.every.append(i)
        self.runs = 0

    def candidates(self, url: str) -> list[int]:
        out = list(self.every)
        for token in set(TOKEN.findall(url)):
            out += self.by_token.get(token, ())
        return sorted(out)

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, str | None]:
        """``host, path, rule, verdict, pattern``."""
        host, path = split_url(url)
        low, where = (url or "").translate(_ASCII), host + path
        best, met = None, {}
        for i in self.candidates(low):
            expression, _, rule = self.rules[i]
            if isinstance(rule, HostRule):
                if not host or best is not None and len(rule.name) <= len(best.name):
                    continue
                self.runs += 1
                if expression.match(where):
                    best = rule
            else:
                if best is not None or rule.verdict in met:  # host rules come first
                    continue
                self.runs += 1
                if expression.search(low):
                    met[rule.verdict] = rule.pattern
        if best is not None:
            return host, path, best.name, best.verdict, None
        verdict = BLOCK if BLOCK in met and ALLOW not in met else ALLOW
        return host, path, None, verdict, met.get(ALLOW) or met.get(BLOCK)


def token_counts(pages: DataFrame, tokens: set[str], url: str = "url") -> Counter:
    """URLs that hold each of the given tokens (one row for each token reaches the driver)."""
    wanted = sorted(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = set(wanted), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(known.intersection(TOKEN.findall(text.translate(_ASCII))))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"])

    counts = pages.select(F.col(url).cast("string")).mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return Counter({r["token"]: r["n"] for r in counts.collect()})


def build_index(pages: DataFrame, hosts: list[HostRule], patterns: list[PatternRule], url: str = "url") -> Index:
    """The rules filed by the tokens that are rarest in ``pages``."""
    plain = Index(hosts, patterns)
    return Index(hosts, patterns, token_counts(pages, {t for _, tokens, _ in plain.rules for t in tokens}, url))


def judge_urls(pages: DataFrame, hosts: list[HostRule] = HOST_RULES, patterns: list[PatternRule] = PATTERN_RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` of every row."""
    index = build_index(pages, hosts, patterns, url)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [index.judge(u) for u in batch.column(1).to_pylist()]
            own = [pa.array([f[i] for f in found], pa.string()) for i in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *own], names=["page_id", "host", "path", "rule", "verdict", "pattern"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"))
    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, pattern string")
