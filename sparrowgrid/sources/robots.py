"""Robots rules: the group of the most specific agent, then the longest matching rule; allow wins ties.

A text is read into rows (group, directive, value); what can't be taken for rules is refused, and refused means that nothing may be fetched.
Patterns are compared in canonical octets (unreserved ones plain, all others percent-encoded in upper case), in which ``*`` and a last ``$`` of a rule
stand for themselves only when they are encoded there.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import quote_from_bytes, unquote_to_bytes

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bounds and known directives.
MOST_LINES, MOST_RULES, MOST_RULE, MOST_DELAY = 10_000, 5_000, 8192, 60.0
DIRECTIVES = ("user-agent", "allow", "disallow", "sitemap", "crawl-delay")

_LINE = re.compile(r"^[ \t]*([^:#]*?)[ \t]*:[ \t]*([^#]*)")
_OCTETS = re.compile(r"%[0-9A-Fa-f]{2}")
#: What a path or rule may hold as it is, besides letters, digits and -._~ .
_PLAIN = "/%?@:!&'()*+,;=$"


class Refused(ValueError):
    """The body is no set of rules that could be followed."""


def octets(text: str) -> str:
    """Canonical octets of a path with query."""
    plain = quote_from_bytes(text.encode(), safe=_PLAIN.encode())
    return _OCTETS.sub(lambda m: quote_from_bytes(unquote_to_bytes(m[0]), safe=b""), plain)


@dataclass(frozen=True)
class Rule:
    """Pieces of a pattern that follow one another; ``ends``: nothing follows the last."""

    allow: bool
    pieces: tuple[str, ...]
    ends: bool

    @classmethod
    def of(cls, directive: str, value: str) -> Rule:
        ends = value.endswith("$")
        return cls(directive == "allow", tuple(octets(p).replace("$", "%24") for p in value.removesuffix("$").split("*")), ends)

    @property
    def weight(self) -> tuple[int, bool]:
        return sum(map(len, self.pieces)), self.allow

    def matches(self, target: str) -> bool:
        """Each piece at its first place after the one before: linear, whatever the pattern."""
        first, *others = self.pieces
        if not target.startswith(first):
            return False
        at = len(first)
        for piece in others[: -1 if self.ends else None]:
            if (at := target.find(piece, at) + len(piece)) < len(piece):
                return False
        if not self.ends:
            return True
        return at == len(target) if not others else len(target) - len(others[-1]) >= at and target.endswith(others[-1])


def rows(body: bytes | str) -> list[tuple[int, str, str]]:
    """(group, directive, value) of a robots text, groups from 1; what stands before any agent has group 0."""
    try:
        text = body if isinstance(body, str) else body.decode("utf-8-sig")
    except UnicodeError:
        raise Refused("encoding") from None
    if "\0" in text or re.search("<html|<!doctype", text, re.I):
        raise Refused("not a rules document")
    lines = text.splitlines()
    if len(lines) > MOST_LINES:
        raise Refused("lines")
    found = [(m[1].lower(), m[2].strip()) for m in map(_LINE.match, lines) if m and m[1].lower() in DIRECTIVES]
    if not found and any(line.split("#", 1)[0].strip() for line in lines):
        raise Refused("no directive")
    # An agent line opens a group unless it follows another agent line, with nothing but sitemaps between.
    kept = [(d, v) for d, v in found if d != "sitemap" and (d != "user-agent" or v)]
    out, group = [], 0
    for k, (directive, value) in enumerate(kept):
        group += directive == "user-agent" and (k == 0 or kept[k - 1][0] != "user-agent" or not group)
        out.append((group, directive, value))
    return out


def rules_for(body: bytes | str, agent: str) -> tuple[list[Rule], float]:
    """The rules for an agent and the delay in seconds that they ask for."""
    table = [r for r in rows(body) if r[0]]
    if sum(d in ("allow", "disallow") and v != "" for _, d, v in table) > MOST_RULES or any(len(v) > MOST_RULE for _, d, v in table if d in ("allow", "disallow")):
        raise Refused("rules")
    if any(d == "crawl-delay" and not (re.fullmatch(r"[0-9]+(\.[0-9]*)?|\.[0-9]+", v) and float(v) <= MOST_DELAY) for _, d, v in table):
        raise Refused("delay")
    product = agent.split("/", 1)[0].lower()
    names = [(len(v), g) for g, d, v in table if d == "user-agent" and v != "*" and v.lower() in product]
    own = {g for n, g in names if n == max(names)[0]} or {g for g, d, v in table if d == "user-agent" and v == "*"}
    mine = [(d, v) for g, d, v in table if g in own]
    return [Rule.of(d, v) for d, v in mine if d in ("allow", "disallow") and v], max((float(v) for d, v in mine if d == "crawl-delay"), default=0.0)


def allowed(body: bytes | str, agent: str, url: str) -> bool:
    """Whether agent may fetch url under the robots text; Refused if the text is no rules document."""
    path = re.sub(r"^[^:/?#]+://[^/?#]*|#.*$", "", url)
    target = octets(path if path.startswith("/") else "/" + path).replace("*", "%2A").replace("$", "%24")
    return max((r.weight for r in rules_for(body, agent)[0] if r.matches(target)), default=(0, True))[1]


def decide(requests: DataFrame, agent: str) -> DataFrame:
    """requests (url, robots binary or string; null: there is none) with ``allowed`` and ``refused``: a refused text allows nothing."""
    names = requests.columns

    def run(batches):
        for pdf in batches:
            out = []
            for url, body in zip(pdf["url"], pdf["robots"]):
                try:
                    out.append((url is not None and (body is None or allowed(body if isinstance(body, str) else bytes(body), agent, url)), None))
                except Refused as e:
                    out.append((False, str(e)))
            yield pdf.assign(allowed=[o[0] for o in out], refused=[o[1] for o in out])

    schema = ", ".join(f"`{c}` {t}" for c, t in requests.dtypes)
    return requests.mapInPandas(run, f"{schema}, allowed boolean, refused string").select(*names, F.col("allowed"), F.col("refused"))
