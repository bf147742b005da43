"""Token counts by whole-token shortcuts.

Once, before any text is read, every entry of the vocabulary that could stand for a whole pre-token is encoded on its own;
those that come out as one token are proven whole tokens. A text is then normalised and cut into pre-tokens as the
tokenizer does; proven ones count one without any merge, and only the rest go through the merges (each distinct one
once per task). Strings of special tokens inside a text count as one token, as the library has it by default.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterlake.llm.common import reader

CACHE = 200_000
# The pre-token pattern of the tokenizer file, for lower-case ASCII and for all of Unicode.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
PLAIN = re.compile(r"[\x00-ɏ‐-‧]*\Z")  # below here lower case does not depend on context
END = "</w>"


def byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: printable Latin-1 stands for itself, the others follow from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = byte_letters()
BYTES = {c: b for b, c in LETTERS.items()}


def spelled(piece: str) -> str:
    return "".join(LETTERS[b] for b in piece.encode())


def unspelled(letters: str) -> str:
    return bytes(BYTES[c] for c in letters).decode("utf-8", "surrogateescape")


def proven(tokenizer: Tokenizer) -> frozenset[str]:
    """Pre-tokens that encode alone as exactly one token."""
    found = set()
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        if not entry.endswith(END) or any(c not in BYTES for c in entry[: -len(END)]):
            continue
        try:
            piece = bytes(BYTES[c] for c in entry[: -len(END)]).decode()
        except UnicodeDecodeError:
            continue
        if piece and len(tokenizer.model.tokenize(spelled(piece))) == 1:
            found.add(piece)
    return frozenset(found)


class Counts(dict):
    """Number of tokens of each pre-token; one that is neither proven nor remembered is merged."""

    def __init__(self, tokenizer: Tokenizer, whole: frozenset[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.tokenizer, self.whole = tokenizer, whole
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values() if t.special]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.model.tokenize(spelled(piece)))
        self[piece] = n
        return n

    def pieces(self, text: str) -> list[str]:
        if text.isascii():
            return ASCII_PIECES.findall(text.lower())
        if PLAIN.match(text) and unicodedata.is_normalized("NFC", text):
            return PIECES.findall(text.lower())
        text = self.tokenizer.normalizer.normalize_str(text)
        return [unspelled(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, text: str) -> int:
        if len(self) > len(self.whole) + CACHE:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        parts, extra = [text], 0
        if self.special and "<|" in text:
            parts = self.special.split(text)
            extra = len(parts) - 1
        return extra + sum(sum(map(self.__getitem__, self.pieces(part))) for part in parts if part)


def driver_text(spark: SparkSession, path: str) -> str:
    if "://" in path:
        return spark.read.text(path, wholetext=True).first()[0]
    return Path(path).read_text(encoding="utf-8")


def count_tokens(docs: DataFrame, vocabulary: str, keep: list[str], limit: int) -> DataFrame:
    """Columns ``keep`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row; a null text counts as empty.

    ``vocabulary`` is the path of a tokenizer file that the driver can read; the file and the proven whole tokens (no
    more than the vocabulary has) go to the executors by broadcast.
    """
    spark = docs.sparkSession
    source = driver_text(spark, vocabulary)
    shared = spark.sparkContext.broadcast((source, proven(Tokenizer.from_str(source))))
    schema = docs.select(*keep).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, whole = shared.value
        counts = Counts(Tokenizer.from_str(file), whole)
        for batch, found in reader(batches, "__text"):
            sizes = [len(t or b"") for t in found]
            tokens = [counts.count(t.decode("utf-8", "replace")) if t else 0 for t in found]
            kept = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                names=schema.names,
            )

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)
