"""Tokenizers of public libraries on executors, from the bytes of their files.

Texts are handed to them in pieces. Where no token can cross the place between a letter or
number and the space after it, a long text is cut at such places: the tokens are the same
and memory no longer grows with the text. Where that is not certain a text stays whole.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import regex

#: Characters after which a text is cut at the next safe place.
PIECE = 1 << 16
#: Something has to follow: a model gives no token to an empty text, not even its own space.
_SAFE = regex.compile(r"(?<=[\p{L}\p{N}]) (?=.)", regex.DOTALL)
#: Fixed value: the character that stands for a space in the pieces of a .model file.
_SPACE = "▁"
#: Texts that show whether a model keeps every space and adds one in front.
_PROBES = ("a b", " a", "a  b", "a ", "  ", "a\n b")


def pieces(text: str, cuttable: bool, size: int | None = None) -> Iterator[str]:
    """The text cut before spaces, which come with the piece after them."""
    size = size or PIECE
    start = 0
    while cuttable and len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class JsonTokenizer:
    """A ``.json`` file; ``plain`` reads the strings of special tokens as any other text."""

    def __init__(self, content: bytes, plain: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain
        self.cuttable = self._cuttable(json.loads(content))

    @staticmethod
    def _cuttable(spec: dict) -> bool:
        """Byte-level splitting by the usual pattern, in which a space only ever starts a match."""
        split = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        return (
            spec.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in added)
        )

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id, entries decoded from the byte-level alphabet."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = (b for b in range(256) if b not in set(shown))
        value = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
        table = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for entry, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            known = all(c in value for c in entry)
            table[i] = bytes(value[c] for c in entry) if known else entry.encode()
        return table


class ModelTokenizer:
    """A ``.model`` file; it puts a space before the text by itself."""

    def __init__(self, content: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.cuttable = self._cuttable()

    def _cuttable(self) -> bool:
        """No piece has a space after another character, and spaces are kept as they are."""
        inner = regex.compile(f"[^{_SPACE}]{_SPACE}")
        if any(inner.search(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())):
            return False
        table = self.token_bytes()
        return all(
            b"".join(table[i] for i in self.model.encode(p)) == f" {p}".encode() for p in _PROBES
        )

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def counts(self, texts: list[str]) -> list[int]:
        return list(map(len, self.ids(texts)))

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id: pieces with spaces, byte pieces as their byte."""
        return [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)])
            if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace(_SPACE, " ").encode()
            for i in range(self.model.get_piece_size())
        ]


@lru_cache(maxsize=8)
def load(kind: str, content: bytes, plain: bool = False) -> JsonTokenizer | ModelTokenizer:
    """The tokenizer of a file's content, made once in a worker."""
    return ModelTokenizer(content) if kind == ".model" else JsonTokenizer(content, plain)


class TokenizerFile:
    """A tokenizer's file, read by the driver and broadcast (a few megabytes, fixed)."""

    def __init__(self, spark, path: str, plain: bool = False) -> None:
        self.kind, self.plain = Path(path).suffix, plain
        if self.kind not in (".json", ".model"):
            raise ValueError(f"no library for {path}")
        content = Path(path).read_bytes()
        self.content = spark.sparkContext.broadcast(content)
        self.version = self._version(content)

    def _version(self, content: bytes) -> str:
        """Hex digest of all that decides the tokens: file, library and options."""
        if self.kind == ".json":
            import tokenizers as library
        else:
            import sentencepiece as library
        named = f"{self.kind} {library.__version__} {self.plain} ".encode()
        return hashlib.sha256(named + content).hexdigest()

    def handed(self):
        """A function for tasks that gives the tokenizer."""
        kind, content, plain = self.kind, self.content, self.plain
        return lambda: load(kind, content.value, plain)
