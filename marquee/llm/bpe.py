"""Token ids of whole texts, by the ``tokenizers`` library inside tasks.

A byte-level BPE never merges across the boundaries of its split pattern, and
white space only ever leads a piece, so a text may be cut before any white
space that follows a non-space character. Each distinct piece is handed to the
library's BPE model once and remembered; the ids of a text are the ids of its
pieces in order (checked against whole-text encoding in the tests). The memory
is bounded: once full, new pieces are encoded anew each time. It never changes
a result.
"""

from __future__ import annotations

from array import array

import numpy as np

from marquee.llm.common import quiet_threads

TOKENIZER = "byte_bpe_50k.json"
_CACHE_PIECES = 400_000
_LONGEST_CACHED = 40


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte that byte-level BPE vocabularies
    use: visible Latin-1 characters stand for themselves, the others follow
    from code point 256 on in byte order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """``encode(texts)`` -> one uint32 array of ids per text, none added.

    With ``as_text`` the strings of special tokens inside a text are ordinary
    text; without, such a text is encoded whole as the library does by default,
    which gives the tokens' own ids. The direct way to the model is taken only
    for a plain byte-level BPE file; any other tokenizer encodes whole texts."""

    def __init__(self, path: str, as_text: bool = True):
        quiet_threads()
        import json

        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = as_text
        self.vocab = self.tok.get_vocab_size(with_added_tokens=True)
        spec = json.loads(self.tok.to_str())
        self.added = [] if as_text else [t["content"] for t in spec["added_tokens"]]
        split = spec["pre_tokenizer"] or {}
        self.plain = (
            spec["normalizer"] is None
            and spec["post_processor"] is None
            and spec["model"]["type"] == "BPE"
            and (split.get("type"), split.get("add_prefix_space"), split.get("use_regex")) == ("ByteLevel", False, True)
        )
        self.model = self.tok.model
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.alphabet = byte_alphabet()
        self.space = self.alphabet[ord(" ")]
        self.memo: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.plain:
            found = self.tok.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, dtype="<u4") for e in found]
        return [np.frombuffer(self._ids(t), dtype="<u4") for t in texts]

    def _ids(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        words = text.split()
        spaces = text.count(" ") + text.count("\n")
        if not words or len(words) != spaces + 1 or len(text) != len("".join(words)) + spaces:
            return b"".join([self._word(w) for w in self.split(text)])
        # each white space is a lone space or line end here: cut before every one
        first, *rest = text.replace("\n", " \n").split(" ")
        known, learn = self.memo.get, self._learn
        return self._piece(first) + b"".join([known(p) or learn(p) for p in rest])

    def _learn(self, piece: str) -> bytes:
        """Ids of a piece after its space; a piece led by a line end has none."""
        if piece.isalpha():
            raw = self._model(self.space + piece) if piece.isascii() else self._word(" " + piece)
        elif piece[-1] in ".,!?" and piece[:-1].isalpha():
            raw = (self.memo.get(piece[:-1]) or self._learn(piece[:-1])) + self._piece(piece[-1])
        else:
            raw = self._piece(piece if piece[0] == "\n" else " " + piece)
        if len(piece) <= _LONGEST_CACHED and len(self.memo) < _CACHE_PIECES:
            self.memo[piece] = raw
        return raw

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece as it stands, by the words of the split pattern."""
        raw = self.marks.get(piece)
        if raw is None:
            raw = b"".join([self.marks.get(w) or self._word(w) for w in self.split(piece)])
            if len(piece) <= 3 and len(self.marks) < _CACHE_PIECES // 10:
                self.marks[piece] = raw
        return raw

    def _word(self, word: str) -> bytes:
        return self._model(word.encode().decode("latin-1").translate(self.alphabet))

    def _model(self, shown: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, as_text: bool = True) -> Encoder:
    """One encoder per Python worker, kept until another operator's work begins there."""
    if (path, as_text) not in _ENCODERS:
        _ENCODERS[path, as_text] = Encoder(path, as_text)
    return _ENCODERS[path, as_text]


def release() -> None:
    _ENCODERS.clear()
