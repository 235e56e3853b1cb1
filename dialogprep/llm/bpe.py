"""Exact token ids of whole texts with cached pieces (runs inside tasks).

A byte-level BPE never merges across pre-tokens, so the ids of a text are
those of its pieces one after the other. Texts are cut at spaces that follow
a character other than white space (always a pre-token boundary); the pieces
repeat, so each is encoded once and then looked up. Misses are encoded by
tiktoken's merge loop over the same vocabulary where the tokenizer file
allows it (its merges come in the order of their ids, byte level, standard
pattern), else by tokenizers itself.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

# Fixed value: the pre-token pattern of byte-level BPE files.
BYTE_LEVEL_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

# White space, in the code points up to U+024F, as the pattern sees it.
_WS = "\\t-\\r \\x85\\xa0"
# Texts with other characters are encoded as a whole: what counts as a
# letter there differs between Unicode versions.
_FOREIGN = re.compile("[^\\x00-\\u024f\\u2010-\\u2027\\u2030-\\u205e]")
# White space before a space: the cut would not be a pre-token boundary.
_RUN = re.compile(f"[{_WS}] ")
_MARKS = frozenset(",.;:!?")
# A safe cut in any text: white space after something else.
_CUT = re.compile(f"(?<=[^{_WS}])(?=[{_WS}])")


class Pieces(dict):
    """Piece -> value; a miss is computed and kept, up to a bound."""

    def __init__(self, compute, max_entries: int):
        self.compute, self.max_entries, self.known = compute, max_entries, {}

    def warm(self, known: dict) -> None:
        """Keep these entries for good, beside the bounded rest."""
        self.known = known
        self.update(known)

    def __missing__(self, piece: str):
        value = self.compute(piece)
        if len(piece) == 1 or (len(piece) <= 32 and "\n" not in piece):
            if len(self) - len(self.known) >= self.max_entries:
                self.clear()
                self.update(self.known)
            self[piece] = value
        return value


def _byte_of() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 stands for itself, the others take U+0100 onwards in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _fast_core(path: str):
    """tiktoken's encoder over the file's vocabulary, or None where its
    results could differ from the library's."""
    with open(path) as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        and spec.get("normalizer") is None and not spec.get("truncation")
    )
    if not plain:
        return None
    vocab = model["vocab"]
    order = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if order != sorted(order) or len(order) + 256 != len(vocab):
        return None
    import tiktoken

    byte = _byte_of()
    ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items()}
    return tiktoken.Encoding("pieces", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe


class Encoder:
    """Ids or counts of whole texts by one tokenizer file.

    ``spaced`` maps a piece (the space before it left out), ``plain`` one
    that has none before it.
    """

    def __init__(self, path: str, counting: bool, max_entries: int = 200_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.core = _fast_core(path)
        self.kind = "<u2" if self.tok.get_vocab_size() <= 65536 else "<u4"
        self.code = "H" if self.kind == "<u2" else "I"
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.pieces_allowed = self.core is not None
        self.counting = counting
        self.join = sum if counting else b"".join
        self.empty = 0 if counting else b""
        self.plain = Pieces(lambda p: self._piece(p, False), max_entries // 4)
        self.spaced = Pieces(lambda p: self._piece(p, True), max_entries)
        self.warmed = None

    def _out(self, ids: list[int]):
        return len(ids) if self.counting else array(self.code, ids).tobytes()

    def library(self, text: str):
        """The library's own result for a whole text."""
        return self._out(self.tok.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str):
        return self._out(self.core.encode_ordinary(text))

    def _piece(self, piece: str, spaced: bool):
        """A piece that was not in the cache: a word, a word with one mark
        after it, two pieces around a line break, or anything else. The
        parts end at pre-token boundaries and repeat more than the whole."""
        if piece.isalpha():
            return self._out(self.core.encode_single_piece((" " + piece if spaced else piece).encode()))
        known = self.spaced if spaced else self.plain
        stem, last = piece[:-1], piece[-1:]
        if last in _MARKS and stem.isalpha():
            return known[stem] + self.plain[last]
        left, line_break, right = piece.partition("\n")
        if line_break and left and not left[-1].isspace() and not right[:1].isspace():
            return known[left] + self.plain[line_break] + (self.plain[right] if right else self.empty)
        return self.encode(" " + piece if spaced else piece)

    def clear(self) -> None:
        """Forget the cached pieces, at a task's end: workers live on."""
        for known in (self.plain, self.spaced):
            known.clear()
            known.known = {}
        self.warmed = None

    def __call__(self, text: str | None):
        """Token count, or the ids as little-endian bytes; null is empty."""
        if not text:
            return self.empty
        if not self.pieces_allowed or any(s in text for s in self.specials):
            return self.library(text)
        if not text.isascii() and _FOREIGN.search(text):
            return self.encode(text)
        if _RUN.search(text):
            return self.join([self.plain[x] for x in _CUT.split(text)])
        first, *rest = text.split(" ")
        head = self.plain[first] if first else self.empty
        return head + self.join(map(self.spaced.__getitem__, rest))


@lru_cache(maxsize=4)
def encoder(path: str, counting: bool) -> Encoder:
    """One encoder per worker, tokenizer and kind."""
    return Encoder(path, counting)
