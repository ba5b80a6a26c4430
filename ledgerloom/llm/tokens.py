"""Byte-level BPE by pieces: the encoder behind token counts and packing.

A public ``.json`` tokenizer with a byte-level pre-tokenizer never joins what
stands on the two sides of a blank or a line feed, so a text is cut there and
each piece is encoded once and remembered. Why the cut is safe: the
pre-tokenizer takes a run of white space before a non-space as (all but the
last character) + (the last one, which a following word may absorb when it is
a blank). Cutting before each blank and around each line feed therefore gives
the same pre-tokens unless a run has three or more characters, or two or more
at the end of the text; such texts, and texts that contain a string of an
added token, go through the library whole.

Whole-token shortcut: ``whole_tokens`` proves, by encoding each vocabulary
string alone, which of them come back as their own single id. A pre-token in
that table needs no merges; only the rest is merged (``merger``).
"""

from __future__ import annotations

import array
import json
import os
import re
import sys
from functools import lru_cache

from .common import claim

_HARD = re.compile(r"\s{3}|\s\s\Z")
#: A text without any of these has no run of white space that matters; others are looked at closely.
_SUSPECT = ("  ", "\n\n", " \n", "\n ", *(chr(c) for c in range(0x110000) if chr(c).isspace() and chr(c) not in " \n"))
_SIMPLE_TOP = "\u0250"          # code points below: letters as in any Unicode version
_PIECES_KEPT = 600_000          # remembered pieces per worker process (about 120 MB)


def cut(text: str) -> list[str]:
    """The pieces of a text without NUL: cut before blanks, around line feeds."""
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: printable Latin-1 bytes stand for themselves, the others are
    numbered from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return [chr(b) if b in set(own) else chr(0x100 + rest.index(b)) for b in range(256)]


@lru_cache(maxsize=4)
def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def cuts_safely(tok) -> bool:
    """True for the tokenizers the piece rule is proved for: byte level with
    the standard pattern, no prefix blank, no normalizer, no random merges."""
    spec = json.loads(tok.to_str())
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and bool(pre.get("use_regex"))
            and not pre.get("add_prefix_space") and model.get("type") == "BPE" and not model.get("dropout")
            and not model.get("ignore_merges"))


def whole_tokens(path: str) -> dict[bytes, int]:
    """Offline proof: vocabulary strings, as bytes, that the library's merges
    turn into exactly their own id, with that id. Bounded by the vocabulary;
    empty for tokenizers the piece rule is not proved for."""
    tok = load(path)
    if not cuts_safely(tok):
        return {}
    byte = {c: b for b, c in enumerate(_byte_chars())}
    added = {t.content for t in tok.get_added_tokens_decoder().values()}
    out = {}
    for word, number in tok.get_vocab(with_added_tokens=False).items():
        got = tok.model.tokenize(word)
        if word not in added and len(got) == 1 and got[0].id == number:
            out[bytes(byte[c] for c in word)] = number
    return out


def merger(path: str):
    """Function from a pre-token's bytes to its ids. Where the id of each
    merge's result grows with the merge's rank, rank-file BPE gives the same
    ids and is faster; else the library's model merges."""
    tok = load(path)
    model = json.loads(tok.to_str())["model"]
    char = _byte_chars()
    byte = {c: b for b, c in enumerate(char)}
    made = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
    single = all(c in model["vocab"] for c in char)
    if single and all(x < y for x, y in zip(made, made[1:], strict=False)):
        try:
            import tiktoken
        except ImportError:
            pass
        else:
            some = set(made) | {model["vocab"][c] for c in char}
            ranks = {bytes(byte[c] for c in word): i for word, i in model["vocab"].items() if i in some}
            if len(ranks) == len(some):
                return tiktoken.Encoding("merges", pat_str=r"(?s).+", mergeable_ranks=ranks,
                                         special_tokens={})._core_bpe.encode_single_piece
    table = dict(enumerate(char))

    def merge(piece: bytes) -> list[int]:
        return [t.id for t in tok.model.tokenize(piece.decode("latin-1").translate(table))]
    return merge


class Pieces(dict):
    """piece -> its ids, filled on first use. ``pack`` turns ids into what is
    remembered (a count, or packed bytes); results add up. ``whole`` has the
    proved whole tokens."""

    def __init__(self, path: str, whole: dict[bytes, int], pack):
        super().__init__()
        self.tok = load(path)
        self.whole = whole
        self.pack = pack
        self.merge = merger(path)
        self.char = {c: b for b, c in enumerate(_byte_chars())}

    def ids(self, piece: str) -> list[int]:
        body = piece[1:] if piece[0] == " " else piece
        if body.isalpha() and max(body) < _SIMPLE_TOP:      # one pre-token: letters with a blank or without
            raw = piece.encode()
            number = self.whole.get(raw)
            return self.merge(raw) if number is None else [number]
        out = []
        for mapped, _ in self.tok.pre_tokenizer.pre_tokenize_str(piece):
            raw = bytes(self.char[c] for c in mapped)
            number = self.whole.get(raw)
            out += self.merge(raw) if number is None else [number]
        return out

    def __missing__(self, piece: str):
        if not piece:
            return self.pack(())
        if len(piece) > 2 and piece[-1] in ".,":
            body = piece[1:-1] if piece[0] == " " else piece[:-1]
            if body.isalpha() and max(body) < _SIMPLE_TOP:  # letters, then one mark: two pre-tokens
                return self[piece[:-1]] + self[piece[-1]]
        found = self.pack(self.ids(piece))
        if len(piece) <= 64:
            if len(self) >= _PIECES_KEPT:                   # bounded: start anew, frequent pieces return at once
                self.clear()
            self[piece] = found
        return found


class Encoder:
    """Encodes whole texts; equal to the library's ``encode`` without special
    tokens added, with strings of added tokens handled as its default."""

    def __init__(self, path: str, whole: dict[bytes, int], pack):
        self.tok = load(path)
        self.pack = pack
        self.fast = cuts_safely(self.tok)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.pieces = Pieces(path, whole, pack) if self.fast else {}

    def by_pieces(self, text: str) -> bool:
        has = text.__contains__
        return (self.fast and not has("\0") and not any(map(has, self.added))
                and not (any(map(has, _SUSPECT)) and _HARD.search(text)))

    def slow(self, text: str):
        return self.pack(self.tok.encode(text, add_special_tokens=False).ids)

    def count(self, text: str) -> int:
        if self.by_pieces(text):
            return sum(map(self.pieces.__getitem__, cut(text)))
        return self.slow(text)

    def packed(self, text: str) -> bytes:
        if self.by_pieces(text):
            return b"".join(map(self.pieces.__getitem__, cut(text)))
        return self.slow(text)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, whole: dict[bytes, int], width: int) -> Encoder:
    """The encoder of this worker process. ``width`` 0 counts tokens, 2 or 4
    packs ids as little-endian integers of so many bytes."""
    claim("tokens", _ENCODERS.clear)
    key = (path, width)
    if key not in _ENCODERS:
        kind = {0: "", 2: "H", 4: "I"}[width]
        little = sys.byteorder == "little"

        def pack_ids(ids) -> bytes:
            a = array.array(kind, ids)
            if not little:
                a.byteswap()
            return a.tobytes()
        _ENCODERS[key] = Encoder(path, whole, len if width == 0 else pack_ids)
    return _ENCODERS[key]
