"""Token ids of whole texts with a public tokenizer, inside Python tasks.

The tokenizers library spends most of its time on normalising and splitting
running text. For a tokenizer that drops white space (it never looks across
it), the ids of a text are the ids of its white-space separated chunks one
after the other. So a few megabytes of text at a time are split by Arrow,
their distinct chunks encoded once, all plain words in a few calls of the
library's model, and the ids put together again by position. Only the
words of the span before are remembered, and only inside a batch, so a
worker's memory does not grow.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes of text whose chunks are encoded together.
SPAN = 8 << 20
#: Words of one call into the library.
CALL_WORDS = 4096

# One chunk a line: a word of lower-case letters that are single code points of
# the normal form, between runs of punctuation (one token class; before a word
# without the apostrophe and "<", which may begin a contraction or a special
# token), or anything else.
_LINES = re.compile("^([!-&(-/:;=-@[-`{-~]*)([a-zß-öø-ÿ]+)([!-/:-@[-`{-~]*)$|^(.*)$", re.M)

# The settings under which chunks are independent (fixed values of the
# public tokenizer file).
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class TextEncoder:
    """``encode_all(texts)`` -> the ids of each text, little-endian unsigned 32-bit."""

    def __init__(self, path: str, span: int = SPAN):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.span = span
        self.by_chunk = self._chunks_are_independent()
        if self.by_chunk:
            # the model alone, for words that need no more normalising or splitting
            self.words = Tokenizer(self.tokenizer.model)
            self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            # how the model spells the two bytes of ß to ÿ, where not as the characters of the same numbers
            spelt = {bytes((0xC3, c & 0xBF)).decode("latin-1"): letters.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
            self.spelt = [(a, b) for a, b in spelt.items() if a != b]
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends_word = np.zeros(max(vocab.values()) + 1, dtype=bool)
            self.ends_word[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True

    def _chunks_are_independent(self) -> bool:
        spec = json.loads(self.tokenizer.to_str())
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        split = (pre.get("pretokenizers") or [{}])[0]
        return ([n.get("type") for n in norm.get("normalizers", [])] == _NORMALIZERS
                and split.get("pattern") == {"Regex": _SPLIT}
                and split.get("behavior") == "Removed" and split.get("invert") is True
                and (spec.get("model") or {}).get("end_of_word_suffix") == "</w>")

    def _ids(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of plain lower-case words; a word's last piece says that it ends."""
        out: list[bytes] = []
        for k in range(0, len(words), CALL_WORDS):
            part = words[k:k + CALL_WORDS]
            text = " ".join(part).encode().decode("latin-1")
            for two, chars in self.spelt:
                text = text.replace(two, chars)
            ids = np.asarray(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            if len(ends) != len(part):
                raise RuntimeError("the tokenizer's words don't end with their own pieces")
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *ends], ends)]
        return out

    def _chunks(self, chunks: list[bytes], last: dict[str, bytes]) -> list[bytes]:
        """Ids of distinct chunks: every bare word and every run of marks once.
        ``last`` has the words of the span before, afterwards those of this one."""
        rows = _LINES.findall(b"\n".join(chunks).decode("utf-8", "replace"))
        words = list(dict.fromkeys(r[1] for r in rows if r[1]))
        known = {w: last[w] for w in words if w in last}
        missing = [w for w in words if w not in known]
        known.update(zip(missing, self._words(missing)))
        last.clear()
        last.update(known)
        marks = {m: self._ids(m) if m else b"" for m in {m for r in rows for m in (r[0], r[2])}}
        return [self._ids(other) if other else marks[before] + known[word] + marks[after] if word else b""
                for before, word, after, other in rows]

    def _together(self, texts: pa.Array, last: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all the texts, where each text's ids begin and the last ones end)."""
        # special tokens are told by their case, nothing else is
        lower = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        parts = pc.ascii_split_whitespace(lower)
        coded = parts.flatten().dictionary_encode()
        ids = self._chunks(coded.dictionary.cast(pa.binary()).to_pylist(), last) if len(coded.dictionary) else []
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        pool, begin = np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(size) - size
        chunk = coded.indices.to_numpy(zero_copy_only=False)
        n = size[chunk]
        upto = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat((begin[chunk] - upto[:-1]).astype(np.int32), n)
        at += np.arange(upto[-1], dtype=np.int32)
        offsets = parts.offsets.to_numpy()
        return pool[at], upto[offsets - offsets[0]]

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of every text, in order; a null text has none."""
        texts = texts.cast(pa.string()).fill_null("")
        if not self.by_chunk:
            for text in texts:
                yield self._ids(text.as_buffer().to_pybytes().decode("utf-8", "replace"))
            return
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        at, last = 0, {}
        while at < len(texts):
            if size[at] > self.span:
                text = texts[at].as_buffer().to_pybytes()
                yield b"".join(self._together(pa.array([part]).view(pa.string()), last)[0].tobytes() for part in spans(text, self.span))
                at += 1
                continue
            upto = max(at + 1, at + int(np.searchsorted(np.cumsum(size[at:]), self.span, side="right")))
            ids, bounds = self._together(texts.slice(at, upto - at), last)
            raw = ids.tobytes()
            for a, b in zip((4 * bounds).tolist(), (4 * bounds[1:]).tolist()):
                yield raw[a:b]
            at = upto

    def encode(self, text: bytes | None) -> bytes:
        return next(self.encode_all(pa.array([text], pa.binary()).view(pa.string())))


def spans(text: bytes, size: int) -> Iterator[bytes]:
    """A text cut at spaces into parts of about ``size`` bytes."""
    at = 0
    while at < len(text):
        upto = text.find(b" ", at + size)
        upto = len(text) if upto < 0 else upto
        yield text[at:upto]
        at = upto


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and tokenizer file."""
    return TextEncoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
