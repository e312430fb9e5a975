"""URL filter: a bit-parallel wildcard automaton over all rules at once.

A URL is canonicalised to `.` + host + NUL + path.  Each rule is a glob over that string,
and all globs are packed into the bits of several 64-bit words.  For each character the
Shift-And step moves every pattern on: `state = ((state << 1 | starts) & accepts[c]) |
(state & loops[c])`, where `loops` holds the positions before a wildcard.  The URLs of a
batch take the step together, one column of characters at a time.  Of the patterns whose
last bit is set at the end, the longest rule decides.

Globs: `?` is any one byte, `*` any number of bytes but NUL (so it stays within the host
or the path), `**` likewise across both.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (host, path, verdict): a rule fits its host and all subdomains if the path starts with its own.
HOST_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DEFAULT = "allow"
#: Texts of a batch down to which they take their steps together.
FEW = 64
_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    """A glob over the canonical URL, what it says, and the name it goes by; longer names win, then block before allow."""

    glob: bytes
    verdict: str
    name: str


def host_rule(host: str, path: str, verdict: str) -> Rule:
    return Rule(b"*." + host.encode() + b"\0" + path.encode() + b"**", verdict, host + path)


class Automaton:
    """The packed masks of a list of rules."""

    def __init__(self, rules: list[Rule]) -> None:
        self.rules = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
        accepts: list[set[int]] = []
        loops: list[str | None] = []
        starts, anywhere, self.last = [], [], []
        for rule in self.rules:
            # One bit before the first byte, so that a leading wildcard is a loop like any other.
            first = len(accepts)
            accepts.append(set())
            loops.append(None)
            starts.append(first)
            i = 0
            while i < len(rule.glob):
                if rule.glob[i : i + 1] == b"*":
                    wide = rule.glob[i : i + 2] == b"**"
                    loops[-1] = "all" if wide or loops[-1] == "all" else "part"
                    i += 2 if wide else 1
                else:
                    accepts.append(set(range(256)) if rule.glob[i : i + 1] == b"?" else {rule.glob[i]})
                    loops.append(None)
                    i += 1
            self.last.append(len(accepts) - 1)
        self.words = -(-len(accepts) // 64)
        mask = lambda bits: np.array([sum(1 << b - 64 * w for b in bits if 64 * w <= b < 64 * w + 64) for w in range(self.words)], np.uint64)
        self.start = mask(starts)
        self.accept = np.stack([mask([i for i, s in enumerate(accepts) if c in s]) for c in range(256)])
        self.loop = np.stack([mask([i for i, x in enumerate(loops) if x == "all" or (x and c)]) for c in range(256)])

        self.wide_accept, self.wide_loop = ([int.from_bytes(m.tobytes(), "little") for m in masks] for masks in (self.accept, self.loop))

    def _step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        shifted = state << np.uint64(1)
        shifted[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return (shifted & self.accept[c]) | (state & self.loop[c])

    def _rest(self, state: np.ndarray, rest: bytes) -> np.ndarray:
        """The state of one text after the rest of it."""
        now, accept, loop = int.from_bytes(state.tobytes(), "little"), self.wide_accept, self.wide_loop
        for c in rest:
            now = (now << 1 & accept[c]) | (now & loop[c])
            if not now:
                break
        return np.frombuffer(now.to_bytes(8 * self.words, "little"), np.uint64)

    def first_match(self, texts: list[bytes]) -> np.ndarray:
        """Of each text, the position in `rules` of the rule that wins, or -1."""
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-length, kind="stable")
        flat = np.frombuffer(b"".join(texts), np.uint8)
        at = (np.cumsum(length) - length)[order]
        length = length[order]
        state = np.repeat(self.start[None], len(texts), 0)
        going = len(texts)
        i, longest = 0, int(length[0]) if len(length) else 0
        while i < longest:
            while length[going - 1] <= i:
                going -= 1
            if going <= FEW:
                break
            state[:going] = self._step(state[:going], flat[at[:going] + i])
            i += 1
        # The few longest go on one by one, as whole numbers: a step costs less than one of the batch.
        for t in range(going if i < longest else 0):
            state[t] = self._rest(state[t], flat[at[t] + i : at[t] + length[t]].tobytes())
        out = np.full(len(texts), -1)
        for k in range(len(self.rules) - 1, -1, -1):
            word, bit = divmod(self.last[k], 64)
            out[order[(state[:, word] >> np.uint64(bit) & np.uint64(1)) > 0]] = k
        return out


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path as they stand in the URL; both empty without `://`."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    for cut in "?#":
        rest = rest.partition(cut)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def url_verdicts(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", rules: list[Rule] | None = None, default: str = DEFAULT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A URL that no rule fits, a null or empty one included, gets the default verdict and a null rule.
    URLs of any length are read whole, in time and memory in proportion to it.  Rows of equal
    or null ids and repeated rows are rows like any other.  Only the two named columns are read.
    """
    automaton = Automaton([host_rule(*r) for r in HOST_RULES] if rules is None else rules)

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judged(urls: pd.Series) -> pd.DataFrame:
        parts = [split_url(u) for u in urls]
        match = automaton.first_match([b"." + h.encode() + b"\0" + p.encode() for h, p in parts])
        names, verdicts = [*(r.name for r in automaton.rules), None], [*(r.verdict for r in automaton.rules), default]
        return pd.DataFrame({"host": [h for h, _ in parts], "path": [p for _, p in parts], "rule": [names[k] for k in match], "verdict": [verdicts[k] for k in match]})

    return pages.select(F.col(id_column).alias("page_id"), judged(F.col(url_column)).alias("_j")).select("page_id", "_j.*")
