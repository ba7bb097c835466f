"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash of the last bytes cuts each text where its value falls in a fixed
class, so equal passages are cut alike wherever they stand.  A chunk met again
in a task is not encoded again.  Tokens near a cut may differ from those of
the whole text, so every join is repaired: the text between an anchor left of
the cut and one right of it is encoded anew, and the anchors move outwards until
the new tokens and the chunks' own agree at both.

An anchor is a place before white space and behind a visible ASCII character.
The pre-tokenizer's pattern never matches across one and does not look ahead
across one, and special tokens hold no white space, so what is encoded on
either side of an anchor does not depend on the other.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm._vec import Slice, byte_table, prefix_hash, slices, window_hash
from orefold.llm.shared import map_arrow

#: Bytes that decide on a cut; cuts are MEAN_CHUNK bytes apart on average.
CUT_WINDOW = 24
MEAN_CHUNK = 1024
#: Bytes of texts and of tokens that a task remembers before it starts anew.
MEMORY_BYTES = 24 << 20


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level BPE vocabulary file; loaded once in each worker."""

    path: str

    def load(self) -> "_Codec":
        return _codec(self.path)


#: The pattern of byte-level BPE pre-tokenizers; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files, and the byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=4)
def _codec(path: str) -> "_Codec":
    return _Codec(path)


class _Codec:
    """Encodes byte strings to arrays of ids, and ids to bytes."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _byte_characters()
        added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        table: list[bytes] = [b""] * (1 + max([*ranks.values(), *added.values()]))
        for token, i in ranks.items():
            table[i] = token
        for token, i in added.items():
            table[i] = token.encode()
        self.table = table
        self.lengths = np.array([len(x) for x in table], np.int64)

    def encode(self, text: bytes) -> np.ndarray:
        return np.array(self.encoding.encode(text.decode("utf-8", "replace"), allowed_special="all"), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.table
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace").encode()


_TABLE = byte_table(11, False)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def cut_places(data: np.ndarray, mean: int = MEAN_CHUNK) -> np.ndarray:
    """Where the rolling hash cuts a slice's bytes; never inside a character."""
    hashes = window_hash(prefix_hash(_TABLE[data]), CUT_WINDOW)
    places = np.flatnonzero(hashes < np.uint64((1 << 64) // mean)) + CUT_WINDOW
    return places[(places < len(data)) & ((data[np.minimum(places, len(data) - 1)] & 0xC0) != 0x80)]


def anchors(data: np.ndarray) -> np.ndarray:
    visible = (data > 32) & (data < 127)
    return np.flatnonzero(_WHITE[data[1:]] & visible[:-1]) + 1


class Encoder:
    """Encodes the texts of slices; remembers chunks and joins across slices."""

    def __init__(self, vocabulary: Vocabulary, mean_chunk: int = MEAN_CHUNK) -> None:
        self.codec, self.mean = vocabulary.load(), mean_chunk
        self.memory: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        self.held = self.chunks = self.reused = self.widened = 0

    def _tokens(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a piece and where its tokens end."""
        found = self.memory.get(text)
        self.chunks += 1
        if found is not None:
            self.reused += 1
            return found
        ids = self.codec.encode(text)
        ends = np.cumsum(self.codec.lengths[ids])
        if self.held > MEMORY_BYTES:
            self.memory.clear()
            self.held = 0
        self.held += 2 * len(text) + 12 * len(ids) + 200
        self.memory[text] = ids, ends
        return ids, ends

    def slice(self, s: Slice) -> Iterator[np.ndarray]:
        cuts, stops = cut_places(s.data, self.mean), anchors(s.data)
        for i in range(s.n):
            a, b = int(s.offsets[i]), int(s.offsets[i + 1])
            own = cuts[np.searchsorted(cuts, a + CUT_WINDOW) : np.searchsorted(cuts, b)]
            yield self._document(s.data[a:b].tobytes(), own - a, stops[np.searchsorted(stops, a, "right") : np.searchsorted(stops, b)] - a)

    def _document(self, text: bytes, cuts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        if not len(cuts):
            return self._tokens(text)[0]
        edges = [0, *cuts.tolist(), len(text)]
        parts = [self._tokens(text[a:b]) for a, b in zip(edges, edges[1:])]
        out: list[np.ndarray] = []
        done = 0  # out holds the tokens of text[:done]; done is 0 or an anchor
        k = 1  # the next join, at edges[k]
        while k < len(edges) - 1:
            left = int(np.searchsorted(stops, edges[k])) - 1
            right = left + 1 if left + 1 < len(stops) else None
            # the left anchor must lie in the chunk before the join, behind done, at the end of one of its tokens
            start, kept = done, np.zeros(0, np.int32)
            while left >= 0 and stops[left] > max(edges[k - 1], done):
                ids, ends = parts[k - 1]
                place = int(stops[left])
                last = int(np.searchsorted(ends, place - edges[k - 1]))
                first = self._from(parts[k - 1], done - edges[k - 1])
                if last < len(ends) and ends[last] == place - edges[k - 1] and first is not None:
                    start, kept = place, ids[first : last + 1]
                    break
                self.widened += 1
                left -= 1
            # the right anchor may lie beyond further joins; their chunks are then encoded with the window
            while True:
                place = int(stops[right]) if right is not None and right < len(stops) else len(text)
                n = k + 1
                while n < len(edges) - 1 and edges[n] <= place:
                    n += 1
                window = self._tokens(text[start:place])
                if place == len(text) or self._from(parts[n - 1], place - edges[n - 1]) is not None:
                    break
                self.widened += 1
                right += 1
            out += [kept, window[0]]
            done, k = place, n
        if done < len(text):
            out.append(parts[-1][0][self._from(parts[-1], done - edges[-2]) :])
        return np.concatenate(out)

    @staticmethod
    def _from(part: tuple[np.ndarray, np.ndarray], place: int) -> int | None:
        """The first token at or behind a place of a chunk, if a token starts there."""
        if place == 0:
            return 0
        i = int(np.searchsorted(part[1], place))
        return i + 1 if i < len(part[1]) and part[1][i] == place else None


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32), pa.int32()))


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name != name), T.StructField(name, kind)])


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """docs with the token ids of the whole text, as the vocabulary's own library encodes it.

    A null or empty text has no ids.  A column named as ids is replaced; all
    others stay.  Strings of special tokens inside a text become those tokens.
    With decoded, the text decoded from the ids follows in a column of that
    name, made by the same worker.
    """
    schema = _with_column(docs, ids, T.ArrayType(T.IntegerType(), False))
    if decoded:
        schema = T.StructType([*(f for f in schema.fields if f.name != decoded), T.StructField(decoded, T.StringType())])
    rest = [f.name for f in schema.fields if f.name not in (ids, decoded)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for s in slices(batch.column(text)):
                part = batch.slice(s.first, s.n)
                found = list(encoder.slice(s))
                columns = [*(part.column(c) for c in rest), _lists(found)]
                if decoded:
                    columns.append(pa.array([encoder.codec.decode(x) for x in found], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(docs, run, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """rows with the text of their ids, special tokens included; null ids give an empty text.

    Bytes that are not UTF-8 become replacement characters.  A column named as
    text is replaced; all others stay.
    """
    schema = _with_column(rows, text, T.StringType())
    rest = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = vocabulary.load()
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                lists = part.column(ids)
                values = [codec.decode(np.asarray(x.values) if x.is_valid else np.zeros(0, np.int32)) for x in lists]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(values, pa.binary()).cast(pa.string())], names=[*rest, text])

    return map_arrow(rows, run, schema)


def digests(rows: DataFrame, ids: str = "token_ids", decoded: str = "decoded", key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256 and decoded_sha256 of encoded and decoded rows."""
    joined = F.array_join(F.col(ids).cast("array<string>"), ",")
    return rows.select(key, F.size(ids).cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"))
