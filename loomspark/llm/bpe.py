"""BPE encoding and decoding by forced boundaries.

A byte pair that occurs inside no token of the vocabulary can never be
bridged by a merge, so between such two bytes there is a certain cut. A
pre-token is split at its certain cuts, the fragments are encoded
independently (and kept, as they recur), and the ids are concatenated.
A text without spaces of any length thus falls into short pieces where
the vocabulary allows it; what cannot be cut is merged with a heap.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Recent, ship, slices, table

#: Fixed value: the public splitting pattern of this kind of vocabulary. \s is spelled out.
_S = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"


#: Rank and new id of a pair that isn't merged: after all others.
NO_MERGE = (1 << 62, -1)


def byte_symbols() -> dict[str, int]:
    """The public printable stand-ins of the 256 bytes: symbol to byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """A byte-level BPE vocabulary in the tokenizers library's JSON format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, symbol = spec["model"], byte_symbols()
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        vocab = {bytes(symbol[c] for c in t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token: list[bytes] = [b""] * size
        for t, i in vocab.items():
            self.token[i] = t
        for t, i in self.special.items():
            self.token[i] = t.encode()
        self.byte_id = [vocab[bytes([b])] for b in range(256)]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        by_text = {t: i for t, i in model["vocab"].items()}
        for rank, m in enumerate(model["merges"]):
            x, y = m.split(" ") if isinstance(m, str) else m
            self.merge.setdefault((by_text[x], by_text[y]), (rank, by_text[x + y]))
        # byte pairs that occur inside some token; between any others is a certain cut
        inside = np.zeros(65536, bool)
        for t in vocab:
            for x, y in zip(t, t[1:], strict=False):
                inside[x << 8 | y] = True
        self.inside = inside.tobytes()
        self.find = regex.compile(PATTERN).findall
        self.forget()
        self.blob = np.frombuffer(b"".join(self.token), np.uint8)
        self.length = np.array([len(t) for t in self.token], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])

    def forget(self) -> None:
        """Drop what is known of recent pieces and fragments."""
        self.pieces, self.fragments = Recent(self._piece, 48 << 20), Recent(self._merged, 24 << 20)

    def cuts(self, piece: bytes) -> list[bytes]:
        """The fragments of a pre-token between its certain cuts."""
        inside, out, at = self.inside, [], 0
        for i, (x, y) in enumerate(pairwise(piece), 1):
            if not inside[x << 8 | y]:
                out.append(piece[at:i])
                at = i
        out.append(piece[at:])
        return out

    def _merged(self, fragment: bytes) -> list[int]:
        ids, merge = [self.byte_id[b] for b in fragment], self.merge
        if len(ids) <= 48:
            # what each pair would merge to; a merge changes the pairs beside it only
            get = merge.get
            found = [get(p, NO_MERGE) for p in pairwise(ids)]
            while found and (best := min(found)) is not NO_MERGE:
                at = found.index(best)
                ids[at : at + 2] = [best[1]]
                del found[at]
                if at:
                    found[at - 1] = get((ids[at - 1], ids[at]), NO_MERGE)
                if at < len(found):
                    found[at] = get((ids[at], ids[at + 1]), NO_MERGE)
            return ids
        n = len(ids)
        left, right, alive = [*range(-1, n - 1)], [*range(1, n), -1], [True] * n
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, x, y, new = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j < 0 or ids[i] != x or ids[j] != y:
                continue
            ids[i], alive[j], right[i] = new, False, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for p, q in ((left[i], i), (i, right[i])):
                if p >= 0 and q >= 0 and (m := merge.get((ids[p], ids[q]))):
                    heapq.heappush(heap, (m[0], p, ids[p], ids[q], m[1]))
        return [x for x, a in zip(ids, alive, strict=True) if a]

    def _piece(self, piece: str) -> bytes:
        ids: list[int] = []
        for f in self.cuts(piece.encode("utf-8", "surrogatepass")):
            ids += self.fragments[f] if len(f) <= 128 else self._merged(f)
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. Strings of special tokens become their ids."""
        out, pieces = [], self.pieces
        parts = self.split_special.split(text) if self.split_special and any(s in text for s in self.special) else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                out += [pieces[p] if len(p) <= 64 else self._piece(p) for p in self.find(part)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Of ids as little-endian unsigned 32-bit integers; special tokens appear as their strings."""
        at = np.frombuffer(ids, "<u4").astype(np.int64)
        if not len(at):
            return ""
        n = self.length[at]
        ends = np.cumsum(n)
        index = np.arange(ends[-1]) + np.repeat(self.start[at] - (ends - n), n)
        return self.blob[index].tobytes().decode("utf-8", "replace")


@lru_cache(2)
def _load(path: str | None) -> ByteBPE:
    return ByteBPE(path or default_path())


def _appended(df: DataFrame, source: str, target: str, kind: T.DataType, arrow: pa.DataType, each, path: str | None) -> DataFrame:
    ship(df.sparkSession)
    df = df.drop(target)
    # a wide row's other columns pass through as they are
    schema = T.StructType([*df.schema.fields, T.StructField(target, kind)])
    at = [c.lower() for c in df.columns].index(source.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _load(path)
        for x in slices(batches):
            out = pa.array([each(bpe, v.as_py()) for v in x.column(at)], arrow)
            yield pa.RecordBatch.from_arrays([*x.columns, out], names=[*x.schema.names, target])
        bpe.forget()

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a binary column of ids (little-endian, unsigned, 32 bits each).

    ``path`` is that of the vocabulary on the executors; without one each of
    them looks up ``default_path`` for itself. Null and empty texts give no
    ids (an empty value). Texts of any length are encoded whole. All other
    columns, of whatever name, are kept, but one already named like the new
    column, in any case, is replaced. Repeated rows fare alike; an empty table gives no rows.
    """
    return _appended(df, text, ids, T.BinaryType(), pa.binary(), lambda bpe, v: bpe.encode(v or ""), path)


def decode(df: DataFrame, path: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that its ids stand for; null and empty ids give the empty text. Columns as in ``encode``."""
    return _appended(df, ids, text, T.StringType(), pa.string(), lambda bpe, v: bpe.decode(v or b""), path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id with the number of its tokens, and the digests of its ids and of what they decode to."""
    x = decode(encode(docs.select("doc_id", "text"), path).drop("text"), path)
    return x.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
