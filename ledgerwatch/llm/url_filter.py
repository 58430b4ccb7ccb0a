r"""Verdicts on URLs by a bit-parallel automaton over all rules at once.

Rules are globs over the canonical URL: a dot, the host with A-Z lower-cased,
and the path. ``*`` is any run without ``/``, ``**`` any run, ``?`` one code
point other than ``/``; a backslash makes the next character literal. A domain
rule such as ``example.net/en/`` is the glob ``*.example.net/en/**``: its host
and all subdomains, paths that start with its path (the first ``/`` of a
canonical URL begins its path, and ``*`` doesn't pass it).

Shift-And with gaps: a glob of m symbols has m + 1 states, one bit each, packed
one glob after another over 64-bit words. A byte moves every state on by one
bit where the next symbol takes it (shift, with carry over words, and a mask by
byte) and keeps the states that a wildcard loops on (a second mask by byte).
One step so simulates all rules, for all URLs of a batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import U64, buffers, slices

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
GLOBS = (("*.ads-**", "block"), ("*.adserver.**", "block"))      # asked only where no domain rule fits
DEFAULT = "allow"
PACK_STATES = 4096       # states simulated together; more rules take further passes over a batch
FEW = 16                 # rows left in a batch below which each is walked alone
SLICE = 1 << 20          # bytes of URLs simulated together

_ALL = np.ones(256, bool)
_NO_SLASH = _ALL.copy()
_NO_SLASH[ord("/")] = False
_MORE = np.zeros(256, bool)
_MORE[0x80:0xC0] = True      # UTF-8 continuation bytes


def domain_glob(rule: str) -> str:
    """The glob of a domain rule ``host/path``."""
    return "*." + re.sub(r"([*?\\])", r"\\\1", rule) + "**"


def symbols(glob: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(bytes taken by each symbol, bytes each state loops on)."""
    take, loop = [], [np.zeros(256, bool)]
    for token in re.findall(r"(?s)\*\*|\*|\?|\\.|.", glob):
        if token in ("*", "**"):
            loop[-1] = loop[-1] | (_ALL if token == "**" else _NO_SLASH)
        elif token == "?":       # the first byte of a code point; the state after it loops on the others
            take.append(_NO_SLASH & ~_MORE)
            loop.append(_MORE.copy())
        else:
            for byte in token[-1].encode():
                take.append(np.arange(256) == byte)
                loop.append(np.zeros(256, bool))
    return take, loop


class Automaton:
    """All given globs as one multiword automaton."""

    def __init__(self, globs: Sequence[str]):
        parts = [symbols(g) for g in globs]
        bits = sum(len(loop) for _, loop in parts)
        self.width = max(1, -(-bits // 64))
        move, stay = np.zeros((256, self.width * 64), bool), np.zeros((256, self.width * 64), bool)
        start, final, at = np.zeros(self.width * 64, bool), [], 0
        for take, loop in parts:
            start[at] = True
            for i, taken in enumerate(take):
                move[:, at + i + 1] = taken          # the first state of a glob is never moved into
            for i, looped in enumerate(loop):
                stay[:, at + i] = looped
            final.append(at + len(take))
            at += len(loop)
        self.final = np.array(final, np.int64)
        self.move, self.stay, self.start = (self._words(x) for x in (move, stay, start[None]))

    @staticmethod
    def _words(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)

    def _alone(self, text: bytes, state: int) -> int:
        """The rest of one URL, its states in one long integer."""
        move, stay = ([int.from_bytes(row.tobytes(), "little") for row in m] for m in (self.move, self.stay))
        for byte in text:
            state = ((state << 1) & move[byte]) | (state & stay[byte])
        return state

    def matches(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which globs each of the texts matches as a whole (rows x globs)."""
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        begin, sorted_size = offsets[:-1][order], -size[order]
        state = np.repeat(self.start, len(size), axis=0)
        for t in range(int(size.max(initial=0))):
            n = int(np.searchsorted(sorted_size, -t, "left"))        # rows longer than t
            if n < FEW:
                for i in range(n):
                    rest = raw[begin[i] + t: begin[i] - sorted_size[i]].tobytes()
                    done = self._alone(rest, int.from_bytes(state[i].tobytes(), "little"))
                    state[i] = np.frombuffer(done.to_bytes(self.width * 8, "little"), np.uint64)
                break
            byte, now = raw[begin[:n] + t], state[:n]
            moved = now << U64(1)
            moved[:, 1:] |= now[:, :-1] >> U64(63)
            state[:n] = (moved & self.move[byte]) | (now & self.stay[byte])
        out = np.empty((len(size), len(self.final)), bool)
        out[order] = (state[:, self.final >> 6] >> (self.final & 63).astype(U64)) & U64(1) == 1
        return out


def packs(globs: Sequence[str]) -> list[tuple[int, Automaton]]:
    """The globs, in order, as automata of about PACK_STATES states, each with
    the number of its first glob."""
    out, held, states, first = [], [], 0, 0
    for i, glob in enumerate(globs):
        if held and states + len(glob.encode()) + 1 > PACK_STATES:
            out.append((first, Automaton(held)))
            held, states, first = [], 0, i
        held.append(glob)
        states += len(glob.encode()) + 1
    return out + ([(first, Automaton(held))] if held else [])


def first_match(automata: list[tuple[int, Automaton]], raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of the first glob that matches each text, -1 where none does."""
    out = np.full(len(offsets) - 1, -1, np.int64)
    for first, automaton in automata:
        hit = automaton.matches(raw, offsets)
        new = (out < 0) & hit.any(axis=1)
        out[new] = first + hit[new].argmax(axis=1)
    return out


def host_of(url: str = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str = "url") -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, globs: Sequence[tuple[str, str]] = GLOBS, default: str = DEFAULT) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule,
    glob, verdict.

    ``rules`` are domain rules (``host/path``, verdict); of those that fit the
    longest wins (ties: the first listed), and ``rule`` names it. Where none
    fits, the first of ``globs`` (glob over the canonical URL, verdict) that
    matches gives the verdict and is named by ``glob``; else it is ``default``.
    Null URLs and URLs without ``://`` have an empty host and path, which fit no
    domain rule. Hosts and paths are read whole, however long. Repeated rows are
    judged each, a null page_id is kept, other columns are ignored, an empty
    table gives an empty result. Rows are judged where they lie, without a
    shuffle; the rules travel with the tasks."""
    ordered = sorted(rules, key=lambda r: -len(r[0]))
    names = [r for r, _ in ordered] + [g for g, _ in globs]
    verdicts = [v for _, v in ordered] + [v for _, v in globs]
    patterns = [domain_glob(r) for r, _ in ordered] + [g for g, _ in globs]
    domains = len(ordered)
    split = pages.select("page_id", host_of().alias("host"), path_of().alias("path")).withColumn("canonical", F.concat(F.lit("."), "host", "path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = packs(patterns)
        for whole in batches:
            for batch in slices(whole, "canonical", SLICE):
                hit = first_match(automata, *buffers(batch.column("canonical"))).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("host"), batch.column("path"),
                     pa.array([names[i] if 0 <= i < domains else None for i in hit], pa.string()),
                     pa.array([names[i] if i >= domains else None for i in hit], pa.string()),
                     pa.array([verdicts[i] if i >= 0 else default for i in hit], pa.string())],
                    ["page_id", "host", "path", "rule", "glob", "verdict"])

    kind = dict(pages.dtypes)["page_id"]
    return split.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, glob string, verdict string")


ORACLE = r"""with s as (
  select page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
r as (
  select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) as t(rule_host, rule_path, rule_verdict)),
f as (
  select s.*, (select max_by(rule_host || rule_path || ' ' || rule_verdict, length(rule_host || rule_path)) from r
    where ends_with('.' || s.host, '.' || rule_host) and starts_with(s.path, rule_path)) as fit from s)
select page_id, host, path, split_part(fit, ' ', 1) as rule,
  case when fit is not null then null when contains('.' || host, '.ads-') then '*.ads-**' when contains('.' || host, '.adserver.') then '*.adserver.**' end as glob,
  case when fit is not null then split_part(fit, ' ', 2) when contains('.' || host, '.ads-') or contains('.' || host, '.adserver.') then 'block' else 'allow' end as verdict
from f"""
