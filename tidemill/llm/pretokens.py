"""Texts to token ids by cached runs: a text is cut at single spaces, each run's ids are kept.

A run is the text between two single spaces, with the space before it. When a run begins and ends
with visible characters, no pre-token crosses its ends, so its ids do not depend on its neighbours.
A text with any other run (double spaces, white space beside a space) is cut by the pattern itself.
Two generations of at most ``MOST_CACHED`` runs each are kept, none longer than ``LONG_RUN`` characters
(text without spaces, or in a script that writes none, is cut by the pattern), so the cache is bounded
in bytes; results never depend on it. The shortcuts for letters suit patterns that keep a run of
letters with the space before it together and full stops and commas apart; with others every text is cut
by the pattern.
A Python worker runs one task after another, so its tasks share one cache (``kept``). Strings and bytes
hold no cycles, so the cycle collector, which would walk the large sets again and again, rests in ``encode``.
"""

from __future__ import annotations

import gc
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain

import regex

from tidemill.llm import common

#: Runs that one generation of a task's cache holds.
MOST_CACHED = 250_000
#: Longer runs are not cached.
LONG_RUN = 128
_FIRST = "\0"                                   # marks a run that no space precedes
_ENDS = (".", ",")


def kept(key: tuple, make: Callable[[], object]):
    """``make()`` for the first task of a Python worker, the same object for later ones with that key.

    Only one key's object is held, so a worker's memory does not grow with the tables it has met; a task
    of another operator drops it (``common.slices``), so it does not stay beside that one's arrays either.
    """
    if key not in common.KEPT:
        common.KEPT.clear()
        common.KEPT[key] = make()
    return common.KEPT[key]


def packed(ids: list[int]) -> bytes:
    """Ids as 32-bit unsigned numbers (little-endian, as on every machine that Spark supports)."""
    return array("I", ids).tobytes()


@contextmanager
def uncollected() -> Iterator[None]:
    """The cycle collector rests meanwhile; it is left as it was found."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class RunCache:
    """Ids of texts as packed bytes. ``encode_all`` maps pre-tokens to the packed ids of each."""

    def __init__(self, pattern: str, encode_all: Callable[[list[str]], list[bytes]], most: int = MOST_CACHED):
        self._find = regex.compile(pattern).findall
        self._encode_all, self._most = encode_all, most
        self._plain = self._find("ab cde, é日 f.") == ["ab", " cde", ",", " é日", " f", "."]
        self._runs: dict[str, bytes | None] = {}
        self._older: dict[str, bytes | None] = {}
        self._pieces: dict[str, bytes] = {}

    def _learn(self, wanted: set[str]) -> None:
        """Ids of new runs. Letters alone are one pre-token, letters and a full stop or comma are two."""
        if len(self._pieces) > self._most:
            self._pieces = {}
        known, pieces = self._runs, self._pieces
        words, ended, others = [], [], {}
        if self._older:
            old = wanted.intersection(self._older)
            known.update((run, self._older[run]) for run in old)
            wanted = wanted - old
        for run in wanted:
            if run.isalpha():
                words.append(run)
            elif run[-1:] in _ENDS and run[:-1].isalpha():
                ended.append(run)
            else:
                body, lead = (run[1:], "") if run[:1] == _FIRST else (run, " ")
                if not body or body[0].isspace() or body[-1].isspace():
                    known[run] = None
                else:
                    others[run] = self._find(lead + body)
        spaced, stems = [" " + run for run in words], [" " + run[:-1] for run in ended]
        new = list({*spaced, *stems, *_ENDS, *chain.from_iterable(others.values())}.difference(pieces))
        pieces.update(zip(new, self._encode_all(new), strict=True))
        known.update(zip(words, map(pieces.__getitem__, spaced), strict=True))
        known.update((run, pieces[stem] + pieces[run[-1]]) for run, stem in zip(ended, stems, strict=True))
        known.update((run, b"".join([pieces[p] for p in each])) for run, each in others.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        with uncollected():
            return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut = []
        for text in texts:
            runs = text.split(" ") if text and self._plain and _FIRST not in text else []
            if runs:
                runs[0] = _FIRST + runs[0]
            cut.append(runs)
        wanted = set(chain.from_iterable(cut))
        if new := wanted.difference(self._runs):
            if long := {run for run in new if len(run) > LONG_RUN}:
                new -= long
                wanted -= long
            if len(self._runs) + len(new) > self._most:             # a new generation, with all of this call's runs
                self._older, self._runs, new = self._runs, {}, wanted
            self._learn(new)
        known, out, whole = self._runs.__getitem__, [], {}
        for k, (text, runs) in enumerate(zip(texts, cut, strict=True)):
            try:
                ids = b"".join(map(known, runs)) if runs or not text else None
            except (TypeError, KeyError):                       # a run that its neighbours change, or a long one
                ids = None
            if ids is None:
                whole[k] = self._find(text)
            out.append(ids)
        new = list(set(chain.from_iterable(whole.values())).difference(self._pieces))
        table = dict(zip(new, self._encode_all(new), strict=True))
        for k, pieces in whole.items():
            out[k] = b"".join([table[p] if p in table else self._pieces[p] for p in pieces])
        return out
