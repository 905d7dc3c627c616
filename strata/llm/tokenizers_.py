"""Exact tokenisation of whole texts with a memory of their parts.

Both public tokenizers used here encode the parts of a text between blanks
independently of each other: the word tokenizer drops white space before its
merges, and no piece of the SentencePiece model holds its blank mark after
another character (checked when the model is loaded). So the ids of a text are
the ids of its parts, one after the other, and parts seen before in a task
need not be encoded again. Texts outside these rules go through the library
whole. The memory is bounded.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from itertools import islice

import numpy as np

MEMORY = 600_000
_FILES: dict[tuple, object] = {}


def resolve(name: str) -> str:
    """Path of a tokenizer file: a path, or a name in the public folder."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def version_digest(name: str) -> str:
    """Digest of the tokenizer file and of the library that reads it."""
    if name.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    h = hashlib.sha256(f"{library.__name__} {library.__version__}".encode())
    with open(resolve(name), "rb") as f:
        h.update(f.read())
    return h.hexdigest()


class _Memory:
    """Values of chunks, in two generations: when the new one is full, the old
    one is forgotten. Chunks in use move to the new one."""

    def __init__(self, blank):
        self.blank, self.new, self.old = blank, {"": blank}, {}

    def values(self, words: list[str], find) -> list:
        """The value of each word; ``find`` gives those of unknown words."""
        out = list(map(self.new.get, words))
        if None in out:
            if len(self.new) > MEMORY:
                self.new, self.old = {"": self.blank}, self.new
            missing = {w for w, v in zip(words, out, strict=True) if v is None}
            unknown = []
            for w in missing:
                v = self.old.get(w)
                if v is None:
                    unknown.append(w)
                else:
                    self.new[w] = v
            self.new.update(zip(unknown, find(unknown), strict=True))
            for i, v in enumerate(out):
                if v is None:
                    out[i] = self.new[words[i]]
        return out


class _Parts(dict):
    """Ids (as bytes) of parts of words, in two generations: when the new one is
    full, the old one is forgotten. Parts in use move to the new one."""

    def __init__(self, find):
        super().__init__()
        self.find, self.old = find, {}

    def __missing__(self, part: str) -> bytes:
        if len(self) > MEMORY:
            self.old = dict(self)
            self.clear()
        out = self.old.get(part)
        out = self[part] = self.find(part) if out is None else out
        return out


class WordTokenizer:
    """A tokenizers .json file; special tokens are not added, their strings in
    a text are read as the library does by default.

    A text of ASCII and Latin-1 letters is cut by the file's own pattern over the
    lower-cased text, and each part goes straight to the library's model, whose
    merges cannot cross parts. (For these characters NFC changes nothing and lower
    case is one to one; their byte marks come from the library's byte-level step.)
    Other texts, and those with the start of a special string, are cut at ASCII
    white space, and their chunks go through all of the library if need be."""

    # The file's pattern, its classes cut down to the plain characters
    # (runs of letters first: no other alternative starts with one).
    PARTS = re.compile("[a-zß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\x00-\x20\x7fa-z0-9ß-öø-ÿ]+")
    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
    PLAIN_TEXT = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
    WHITE = re.compile("[\t-\r ]")
    # Normaliser and pattern of a file to which this applies.
    SHAPE = (["NFC", "Replace", "Lowercase"],
             r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    PIECE = 1 << 20

    def __init__(self, name: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        self.library = Tokenizer.from_file(resolve(name))
        with open(resolve(name), encoding="utf-8") as f:
            spec = json.load(f)
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = [x.get("type") for x in norm.get("normalizers", [])]
        cuts = [x.get("pattern", {}).get("Regex") for x in pre.get("pretokenizers", [])][:1]
        # Only a tokenizer that drops white space is free of what stands around a chunk.
        self.by_part = (steps, cuts) == (self.SHAPE[0], [self.SHAPE[1]])
        step = ByteLevel(add_prefix_space=False, use_regex=False)
        self.marks = {c: step.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.model, self.parts = self.library.model, _Parts(self._part)

    def _part(self, part: str) -> bytes:
        made = self.model.tokenize(part if part.isascii() else part.translate(self.marks))
        return array("I", [t.id for t in made]).tobytes()

    def _library(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), 20_000):
            made = self.library.encode_batch_fast(texts[at:at + 20_000], add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in made]
        return out

    def _by_parts(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, self.PARTS.findall(text.lower())))

    def _pieces(self, text: str):
        """A text cut at white space, so that few parts are held at once."""
        at = 0
        while len(text) - at > self.PIECE:
            stop = self.WHITE.search(text, at + self.PIECE)
            if not stop:
                break
            yield text[at:stop.start()]
            at = stop.start()
        yield text[at:]

    def _chunked(self, text: str) -> bytes:
        chunks = self.WHITE.split(text)
        plain = ["<|" not in c and self.PLAIN.fullmatch(c) is not None for c in chunks]
        rest = iter(self._library([c for c, p in zip(chunks, plain, strict=True) if not p]))
        return b"".join([self._by_parts(c) if p else next(rest) for c, p in zip(chunks, plain, strict=True)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if not self.by_part:
            return [np.frombuffer(x, np.uint32) for x in self._library(texts)]
        out = []
        for text in texts:
            plain = "<|" not in text and self.PLAIN_TEXT.fullmatch(text)
            make = self._by_parts if plain else self._chunked
            out.append(np.frombuffer(b"".join([make(x) for x in self._pieces(text)]), np.uint32))
        return out

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.encode(texts)]


class PieceTokenizer:
    """A sentencepiece .model file; counts without begin and end tokens."""

    BLANK = "▁"

    def __init__(self, name: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=resolve(name))
        with open(resolve(name), "rb") as f:
            spec = pb.ModelProto.FromString(f.read())
        plain = spec.normalizer_spec
        inside = re.compile(f"[^{self.BLANK}]{self.BLANK}")
        self.by_chunk = (plain.name == "identity" and plain.add_dummy_prefix and not plain.remove_extra_whitespaces
                         and plain.escape_whitespaces and not plain.precompiled_charsmap
                         and not any(inside.search(p.piece) or p.type == 4 for p in spec.pieces))
        self.chunks = _Memory(0)

    def _library(self, texts: list[str]) -> list[int]:
        return [len(x) for at in range(0, len(texts), 20_000)
                for x in self.library.encode(texts[at:at + 20_000], num_threads=1)]

    def count(self, texts: list[str]) -> list[int]:
        """A chunk is a word with the blanks before it; the library itself puts
        one blank before what it encodes."""
        cut: list[list[str] | None] = []
        for t in texts:
            if not self.by_chunk or not t or t[-1] == " " or self.BLANK in t:
                cut.append(None)
            elif "  " in t or t[0] == " ":
                first, *rest = re.findall(" *[^ ]+", t)
                cut.append([first, *(x[1:] for x in rest)])
            else:
                cut.append(t.split(" "))
        values = iter(self.chunks.values([w for words in cut if words is not None for w in words], self._library))
        return [len(self.library.encode(t, num_threads=1)) if words is None else sum(islice(values, len(words)))
                for t, words in zip(texts, cut, strict=True)]


def load(name: str) -> WordTokenizer | PieceTokenizer:
    """The tokenizer of a file, kept in the Python worker."""
    if name not in _FILES:
        _FILES[name] = PieceTokenizer(name) if name.endswith(".model") else WordTokenizer(name)
    return _FILES[name]


def in_slices(texts, chars: int = 4_000_000):
    """Lists of consecutive texts of about ``chars`` characters at most, so that
    what is held for one slice stays small whatever the batch."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= chars:
            yield held
            held, n = [], 0
    if held:
        yield held
