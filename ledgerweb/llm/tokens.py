"""Token ids of whole texts from a public tokenizer file, by way of a word memo.

The tokenizer drops white space before anything else looks at a text, so a text's ids are the
ids of its words in order.  Each worker keeps the ids of words it has met; a plain word (Latin
letters, perhaps between punctuation marks) goes straight to the BPE model, all others through
the whole tokenizer.  The memo is emptied when full: it saves time and never changes an id.

That holds for files whose normalizer, pre-tokenizer and model settings are those of ``MEMO_FITS``;
with any other file every text goes through the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import string
import unicodedata

import numpy as np

#: Words that one worker remembers.
MEMO_WORDS = 900_000
#: Words with more bytes than this are encoded each time.
MEMO_BYTES = 48
#: How the tokenizer has to take a text apart for words to have ids of their own (fixed values of its file).
MEMO_FITS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False},
}
#: Id that ends each document.
END_ID = 1

_ID = np.dtype("<u4")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder(dict):
    """Maps the bytes of one word to its ids as little-endian 32-bit integers."""

    def __init__(self, path: str | None = None):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_tokenizer())
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces: dict[str, bytes] = {}
        told = json.loads(self.tokenizer.to_str())
        told["model"] = {k: v for k, v in told["model"].items() if k not in ("vocab", "merges")}
        self.by_words = all(told[k] == v for k, v in MEMO_FITS.items())
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256
        plain = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
        others = [b for b in range(256) if b not in plain]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            shown = piece.encode().decode("latin-1").translate(self.alphabet)
            ids = self.pieces[piece] = np.array([t.id for t in self.model.tokenize(shown)], _ID).tobytes()
        return ids

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.clear()
        if len(self.pieces) >= MEMO_WORDS // 2:
            self.pieces.clear()
        text = word.decode("utf-8", "replace")
        head = tail = ""
        if text.isalpha():
            core = text
        elif text[:-1].isalpha() and text[-1] in string.punctuation:
            core, tail = text[:-1], text[-1]
        elif any(x in text for x in self.special):
            core, head = "", "'"
        elif core := text.strip(string.punctuation):
            head, _, tail = text.partition(core)
        else:
            head = text
        if len(word) > MEMO_BYTES or "'" in head or core and not (core.isalpha() and (core.isascii() or max(core) < "ɐ" and core.lower().isalpha() and unicodedata.is_normalized("NFC", core))):
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, _ID).tobytes()
        else:
            ids = self._piece(core.lower()) if core else b""
            if head or tail:
                ids = b"".join([self._piece(head) if head else b"", ids, self._piece(tail) if tail else b""])
        if len(word) <= MEMO_BYTES:
            self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text (null: none), without the end id.  Only ASCII white space parts words here."""
        if not self.by_words:
            return np.array(self.tokenizer.encode(text or "", add_special_tokens=False).ids, _ID).tobytes()
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split())) if text else b""


_encoders: dict[str | None, WordEncoder] = {}


def encoder(path: str | None = None) -> WordEncoder:
    """One encoder for each worker process and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


END = np.array([END_ID], _ID).tobytes()
