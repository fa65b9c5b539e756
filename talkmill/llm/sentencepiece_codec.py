"""SentencePiece encoding and decoding with byte spans of the original text.

Normalisation follows the compiled character map of the model: at each place the longest prefix that the map holds is
replaced, else one character is copied. Spaces become the meta symbol, a dummy one goes in front, and, where the model
says so, runs and ends of white space are dropped. With each byte of the normalised text goes the byte of the original
from which it came, so that every piece, by its length in normalised bytes, gets a span of original bytes.

Pieces come from the sentencepiece library, asked once for each distinct stretch of text: where no piece joins what
stands before a space (or a line end) with what follows, merges of one stretch never touch another, so the pieces of a
text are those of its stretches. Models for which that does not hold, and models that are not BPE, are asked for whole
texts. The lengths of the pieces must add up to the normalised text; else the library's answer for the whole text and
its own surfaces are taken.

Cases: null and empty text give no pieces and decode to ""; very long texts are done whole; repeated rows each give a
row; an empty table gives an empty table; other columns of the input are kept unless an output column has their name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, small

META = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Distinct stretches that a worker remembers.
REMEMBER = 300_000


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a serialised protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at : at + n]
            at += n


class CharsMap:
    """The compiled character map: a double-array trie (darts-clone) and the strings that replace its keys."""

    def __init__(self, blob: bytes):
        n = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + n], "<u4").tolist()
        self.strings = blob[4 + n :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes of data matched, what replaces them) for the longest key that data has at `at`."""
        if not self.units:
            return None
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        start = found[1]
        return found[0], self.strings[start : self.strings.index(b"\0", start)]


class Model:
    """A SentencePiece model file: its pieces, its normaliser and the library's processor."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: list[tuple[str, int]] = []
        trainer, norm = {}, {}
        for number, value in _fields(data):
            if number == 1:
                x = dict(_fields(value))
                self.pieces.append((x[1].decode(), x.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                norm = dict(_fields(value))
        self.map = CharsMap(norm.get(2, b""))
        self.dummy, self.squeeze, self.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        self.suffix = bool(trainer.get(24, 0))
        self.users = sorted((p.encode() for p, kind in self.pieces if kind == USER), key=len, reverse=True)
        self.lengths = np.array([1 if kind == BYTE else 0 if kind in (CONTROL, UNKNOWN) else len(p.encode()) for p, kind in self.pieces], dtype=np.int64)
        texts = [p for p, kind in self.pieces if kind in (NORMAL, USER)]
        plain = not self.map.units and not self.squeeze and self.escape and self.dummy and not self.suffix and not self.users
        self.by_stretch = plain and trainer.get(3, 1) == 2 and not any(META in p.lstrip(META) or "\n" in p for p in texts) and self.lib.unk_id() >= 0 and bool(trainer.get(35, 0))
        self.meta_id = self.lib.piece_to_id(META)
        #: bytes of the text behind each piece where only spaces are changed
        self.sources = self.lengths - 2 * np.array([p.count(META) if kind in (NORMAL, USER) else 0 for p, kind in self.pieces], np.int64)
        self._forget()

    # -- normalisation ------------------------------------------------------------------------------------------

    def normalize(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised text as UTF-8, and for each of its bytes, and the end, the byte of the text it came from."""
        data = text.encode()
        if not data:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze and not self.users:
            return self._plain(data)
        meta = META.encode() if self.escape else b" "
        out, source, at, end = bytearray(), [], 0, len(data)

        def prefix(at: int) -> tuple[int, bytes]:
            for u in self.users:
                if data.startswith(u, at):
                    return len(u), u
            if got := self.map.longest(data, at):
                return got
            b = data[at]
            n = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            return n, data[at : at + n]

        if self.squeeze:
            while at < end:
                n, what = prefix(at)
                if what != b" ":
                    break
                at += n
            if at == end:
                return b"", np.zeros(1, np.int64)
        if self.dummy and not self.suffix:
            out += meta
            source += [at] * len(meta)
        space = self.squeeze
        while at < end:
            n, what = prefix(at)
            if space and self.squeeze:
                what = what.lstrip(b" ")
            for b in what:
                if b == 32:
                    out += meta
                    source += [at] * len(meta)
                else:
                    out.append(b)
                    source.append(at)
            if what:
                space = what.endswith(b" ")
            at += n
        if self.squeeze:
            while out.endswith(meta):
                del out[-len(meta) :]
                at = source[len(out)]
                del source[len(out) :]
        if self.dummy and self.suffix:
            out += meta
            source += [at] * len(meta)
        return bytes(out), np.array([*source, at], np.int64)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """No character map: only spaces change."""
        raw = np.frombuffer(data, np.uint8)
        meta = META.encode() if self.escape else b" "
        front = meta if self.dummy and not self.suffix else b""
        back = meta if self.dummy and self.suffix else b""
        sizes = np.where(raw == 32, len(meta), 1)
        source = np.repeat(np.arange(len(raw)), sizes)
        return front + data.replace(b" ", meta) + back, np.concatenate([np.zeros(len(front), np.int64), source, np.full(len(back) + 1, len(raw))])

    # -- pieces --------------------------------------------------------------------------------------------------

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of all texts, one after another, and where each text begins (and the last ends)."""
        if not self.by_stretch:
            got = [x for x in self.lib.encode(texts, num_threads=1)] if texts else []
            at = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int64)
            return np.fromiter(chain.from_iterable(got), np.int32, int(at[-1])), at
        if len(self.known) > REMEMBER:
            self._forget()
        known, cut = self.known, [STRETCH.findall(" " + t.replace(META, " ")) if t else [] for t in texts]
        if new := list({s for x in cut for s in x if s not in known}):
            self._learn(new)
        sizes = np.array([len(x) for x in cut], np.int64)
        which = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        n = self.count[which]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = ends[np.concatenate([[0], np.cumsum(sizes)])]
        return self.flat[np.repeat(self.start[which] - ends[:-1], n) + np.arange(ends[-1])], at

    def _forget(self) -> None:
        self.known, self.flat = {}, np.zeros(0, np.int32)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, new: list[str]) -> None:
        # with the library's own dummy space in front; before a line end that space is a piece of its own
        got = self.lib.encode([s[1:] if s[0] == " " else s for s in new], num_threads=1)
        got = [[self.meta_id] if s == " " else ids if s[0] == " " else ids[1:] for s, ids in zip(new, got)]
        n = np.array([len(x) for x in got], np.int64)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(n) - n])
        self.count = np.concatenate([self.count, n])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(got), np.int32, int(n.sum()))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first bytes, bytes past the last, where each text begins) of the pieces of all texts."""
        ids, at = self.ids(texts)
        if not self.by_stretch:
            found = [self.spans(t, ids[a:b].tolist()) for t, a, b in zip(texts, at[:-1], at[1:])]
            at = np.concatenate([[0], np.cumsum([len(x[0]) for x in found])]).astype(np.int64)
            return np.fromiter(chain.from_iterable(x[0] for x in found), np.int32, int(at[-1])), *(np.concatenate([np.zeros(0, np.int64), *[x[k] for x in found]]) for k in (1, 2)), at
        # without a character map the alignment has a closed form: a meta symbol stands for one space, the dummy one for none
        metas = np.array([t.count(META) if t else 0 for t in texts], np.int64)
        if metas.any():  # a meta symbol that the text itself has keeps its three bytes
            parts = [self.spans(t, ids[a:b].tolist()) for t, a, b in zip(texts, at[:-1], at[1:])]
            return ids, *(np.concatenate([np.zeros(0, np.int64), *[x[k] for x in parts]]) for k in (1, 2)), at
        size = self.sources[ids]
        full = at[:-1] < at[1:]
        size[at[:-1][full]] -= 1
        ends = np.cumsum(size)
        base = np.concatenate([[0], ends])[at[:-1]]
        n = np.diff(at)
        ends -= np.repeat(base, n)
        if not np.array_equal(ends[at[1:][full] - 1], np.array([len(t.encode()) for t in texts if t], np.int64)):
            raise ValueError("pieces that don't cover the text")
        return ids, ends - size, ends, at

    def spans(self, text: str, ids: list[int]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(ids, first byte, byte past the last) of each piece in the text as UTF-8; the spans follow each other."""
        normal, source = self.normalize(text)
        ends = np.cumsum(self.lengths[ids]) if ids else np.zeros(0, np.int64)
        if (ends[-1] if len(ends) else 0) != len(normal):
            got = self.lib.encode(text, out_type="immutable_proto").pieces
            ids = [p.id for p in got]
            sizes = [int(self.lengths[p.id]) or len(self._surface(p)) for p in got]
            ends = np.cumsum(sizes) if sizes else np.zeros(0, np.int64)
            if (ends[-1] if len(ends) else 0) != len(normal):
                raise ValueError(f"pieces of {ends[-1:]} bytes for {len(normal)} normalised ones")
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        return ids, source[starts], source[ends]

    def _surface(self, piece) -> bytes:
        return piece.piece.replace(" ", META).encode()


#: A line end and what follows up to a space or line end; or spaces and what follows; with a space put in front of the text.
STRETCH = re.compile(r"\n[^ \n]*| +[^ \n]*")


@lru_cache(maxsize=4)
def model(path: str) -> Model:
    """One model a worker process."""
    return Model(path)


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, path: str, text: str = "text", spans: bool = True, decoded: bool = False) -> DataFrame:
    """Adds ids (array of int); with `spans`, starts and ends (bytes of the original as UTF-8); with `decoded`, the decoded text.

    The spans are found, and checked to cover the normalised text, whether or not they are returned."""
    adds = [("ids", T.ArrayType(T.IntegerType(), False)), *([("starts", T.ArrayType(T.LongType(), False)), ("ends", T.ArrayType(T.LongType(), False))] if spans else []), *([("decoded", T.StringType())] if decoded else [])]
    names = {n for n, _ in adds}
    kept = docs.select(F.col(text).alias("_text"), *[F.col(f"`{c}`") for c in docs.columns if c not in names and c != "_text"])
    schema = T.StructType([*kept.schema.fields[1:], *[T.StructField(n, kind, False) for n, kind in adds]])

    def run(batches):
        m = model(path)
        for batch in small(batches):
            texts = [x or "" for x in batch.column(0).to_pylist()]
            ids, starts, ends, at = m.encode(texts)
            where = pa.array(at.astype(np.int32))
            cols = [pa.ListArray.from_arrays(where, ids)]
            if spans:
                cols += [pa.ListArray.from_arrays(where, starts), pa.ListArray.from_arrays(where, ends)]
            if decoded:
                cols.append(pa.array([m.lib.decode(ids[a:b].tolist()) if a < b else "" for a, b in zip(at[:-1], at[1:])], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *cols], names=schema.names)

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the library's decoding of a column of ids (null: "")."""
    schema = T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, T.StringType())])

    def run(batches):
        lib = model(path).lib
        for batch in small(batches):
            texts = [lib.decode(x) if x else "" for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in schema.names[:-1]], pa.array(texts, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)


def op1_sentencepiece(spark, sf_dir: str) -> DataFrame:
    got = encode(documents(spark, sf_dir).select("doc_id", "text"), public_model(), spans=False, decoded=True)
    joined = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
