"""Byte-level BPE over a public vocabulary: pieces, ids and raw bytes.

The vocabulary file's content (about 1 MB, fixed) is read on the driver and
broadcast, so executors need the tokenizer library but not the file's path.
"""

from __future__ import annotations

import base64
import json
from array import array
from pathlib import Path

from pyspark.sql import SparkSession

from tidewater.llm.common import per_process

#: Pre-tokens whose ids a worker remembers.
CACHE_PIECES = 250_000


def parse_tiktoken(content: bytes) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: a base64 token and its rank in each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary file writes bytes: printable
    Latin-1 stands for itself, every other byte for the next letter from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def parse_json(content: bytes) -> dict[bytes, int]:
    """Ranks of a ``tokenizers`` JSON file with a byte-level BPE, without added tokens.

    The merges of such a file are in the order of the ids they make, so ids are ranks.
    """
    spec = json.loads(content)
    letters = byte_letters()
    added = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}


def added_tokens(content: bytes) -> dict[str, int]:
    """Added tokens of a ``tokenizers`` JSON file, which the library finds in the text before it splits it."""
    added = json.loads(content).get("added_tokens", [])
    if any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word")):
        raise ValueError("added tokens that take in white space or whole words only are not supported")
    return {t["content"]: t["id"] for t in added}


class Vocabulary:
    """Handle that tasks use to get at the encoder; cheap to ship."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        content = Path(path).read_bytes()
        self.key = f"bpe:{hash((content, pattern))}"
        self.pattern = pattern
        self.is_json = path.endswith(".json")
        self.content = spark.sparkContext.broadcast(content)

    def encoder(self) -> "Encoder":
        def build():
            content = self.content.value
            return Encoder(parse_json(content), self.pattern, added_tokens(content)) if self.is_json else Encoder(parse_tiktoken(content), self.pattern)

        return per_process(self.key, build)


class _Pieces(dict):
    """Pre-token -> ids as little-endian uint32 bytes, computed when first asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece):
        made = array("I", self.encode(piece.encode())).tobytes()
        if len(self) < CACHE_PIECES and len(piece) <= 64:
            self[piece] = made
        return made


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str, added: dict[str, int] | None = None):
        import regex
        import tiktoken

        core = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.ordinary = core.encode_ordinary
        self.pieces = _Pieces(core.encode_single_piece)
        self.pre_tokens = regex.compile(pattern).findall
        self.added = added or {}
        self.longest_added = max(map(len, self.added), default=0)
        #: Cuts a text at its added tokens, of which the longest counts; they stand at the odd places.
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        self.pieces.update((t, array("I", [i]).tobytes()) for t, i in self.added.items())
        known = ranks | {t.encode(): i for t, i in self.added.items()}
        self.table = [b""] * (max(known.values()) + 1)
        for token, rank in known.items():
            self.table[rank] = token

    def parts(self, text: str) -> list[str]:
        """Stretches of ordinary text and, at the odd places, the added tokens between them."""
        return self.cut(text) if self.cut else [text]

    def split(self, text: str) -> list[str]:
        """Pre-tokens and added tokens of a text, in order; they join to the text."""
        parts = self.parts(text)
        if len(parts) == 1:
            return self.pre_tokens(text)
        return [p for k, part in enumerate(parts) for p in ([part] if k % 2 else self.pre_tokens(part))]

    def encode_text(self, text: str) -> bytes:
        ids = []
        for k, part in enumerate(self.parts(text)):
            ids += [self.added[part]] if k % 2 else self.ordinary(part)
        return array("I", ids).tobytes()

    def encode_pieces(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, pieces))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))
