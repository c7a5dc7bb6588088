"""Paragraphs of a text: what fingerprints and substring dedup compare."""

from __future__ import annotations

import re

#: A paragraph ends at a line break, or after a sentence mark that white space follows.
_END = re.compile(r"\n+|(?<=[.!?])[ \t\r\f\v]+")
#: The longest paragraph in words; beyond, cuts follow words whose digest has this many low zero bits.
LONG_WORDS, CUT_BITS = 24, 3
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def paragraph_spans(text: str, least_words: int = 1) -> list[tuple[int, int]]:
    """Start and end of each paragraph, outer white space left out.

    A sentence of fewer than ``least_words`` words is joined to the one behind it on its line.
    Where a boundary falls depends only on the sentence before it, so that a passage is cut
    alike in whatever text it stands.
    """
    spans: list[tuple[int, int]] = []
    at = 0
    for m in _END.finditer(text):
        if text[m.start()] != "\n" and least_words > 1:
            sentence = text[max(at, _last_end(text, at, m.start())) : m.start()]
            if len(sentence.split()) < least_words:
                continue
        _add(text, at, m.start(), spans)
        at = m.end()
    _add(text, at, len(text), spans)
    return spans


def _last_end(text: str, at: int, stop: int) -> int:
    """Where the last sentence of ``text[at:stop]`` begins."""
    best = at
    for mark in (". ", "! ", "? "):
        best = max(best, text.rfind(mark, at, stop) + 2 if text.rfind(mark, at, stop) >= 0 else at)
    return best


def _add(text: str, start: int, end: int, spans: list[tuple[int, int]]) -> None:
    part = text[start:end]
    bare = part.strip(" \t\r\n\f\v")
    if not bare:
        return
    start += len(part) - len(part.lstrip(" \t\r\n\f\v"))
    end = start + len(bare)
    if len(bare) < 2 * LONG_WORDS:
        spans.append((start, end))
        return
    words = [m.span() for m in WORD.finditer(bare)]
    if len(words) <= LONG_WORDS:
        spans.append((start, end))
        return
    from xxhash import xxh32_intdigest

    at = words[0][0]
    for a, b in words:
        if not xxh32_intdigest(bare[a:b]) & ((1 << CUT_BITS) - 1):
            spans.append((start + at, start + b))
            at = b
    if bare[at:].strip():
        at += len(bare[at:]) - len(bare[at:].lstrip())
        spans.append((start + at, end))
