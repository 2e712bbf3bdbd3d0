"""Operator 8: byte-level BPE encoding by overlapping chunks, and decoding.

A text is cut into chunks that overlap.  Every chunk is pre-tokenised on its
own, in parallel; a chunk that starts inside a pre-token goes wrong at first,
but from the first boundary it shares with its predecessor inside the overlap
both read the same matches.  Two neighbours are stitched there, and every
chunk encodes the pieces between its two stitches.  Decoding concatenates the
raw bytes of the ids.

Edge cases: a null text is an empty one (no ids); an empty text gives one row
with no ids; repeated rows give repeated rows (rows are told apart by an
internal row key, not by ``doc_id``); a null ``doc_id`` is kept; extra columns
are ignored.  A very long text is many chunk rows; only its ids meet again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .common import Scratch, table

#: Characters of a chunk and of the overlap with its successor.
CHUNK, OVERLAP = 16_384, 256
#: A match that ends nearer than this to the end of a chunk may depend on what follows it.
MARGIN = 4
#: Texts a worker turns into output rows at a time.
SLICE = 512


def cut_points(text: str, chunk: int, overlap: int) -> list[int]:
    """Starts of the chunks.

    A place is cut only if its overlap holds a step from a non-space character
    to a space, well before the overlap's end: the pattern always has a
    boundary there, so neighbours are sure to meet.  Else the chunk goes on.
    """
    cuts, at = [0], chunk
    while at < len(text) - overlap:
        win = text[at : at + overlap - 2 * MARGIN]
        if any(b == " " and not a.isspace() for a, b in zip(win, win[1:])):
            cuts.append(at)
            at += chunk
        else:
            at += overlap
    return cuts


def boundaries(rx, text: str) -> np.ndarray:
    """Where the matches of the pattern start, and the end of the text."""
    return np.array([m.start() for m in rx.finditer(text)] + [len(text)], np.int64)


def stitch(mine: np.ndarray, size: int, theirs: np.ndarray, shift: int) -> int:
    """First boundary (in my places) that my chunk and my successor's, which starts at ``shift``, both have."""
    safe = mine[(mine >= shift) & (mine <= size - MARGIN)]
    both = np.intersect1d(safe, theirs + shift)
    both = both[both > shift] if shift else both
    if not len(both):
        raise ValueError("neighbouring chunks share no boundary")
    return int(both[0])


CODED = "rk long, doc_id long, n_tokens long, ids binary"


def as_coded(rank_file: str | None, rows: list[tuple]) -> pd.DataFrame:
    """The plain form of coded rows (row key, doc_id, ids)."""
    return pd.DataFrame([(k, d, len(ids), ids.tobytes()) for k, d, ids in rows], columns=["rk", "doc_id", "n_tokens", "ids"])


def _encode_whole(rank_file: str | None, finish):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = bpe.coder(rank_file)
        for pdf in batches:
            for a in range(0, len(pdf), SLICE):
                rows = pdf.iloc[a : a + SLICE]
                yield finish(rank_file, [(k, d, np.array(c.encode(t), "<u4")) for k, d, t in zip(rows["rk"], rows["doc_id"], rows["text"])])
    return run


def _finish_joined(rank_file: str | None, finish):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), SLICE):
                rows = pdf.iloc[a : a + SLICE]
                yield finish(rank_file, [(k, d, np.frombuffer(b, "<u4")) for k, d, b in zip(rows["rk"], rows["doc_id"], rows["ids"])])
    return run


def _split(chunk: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, doc_id, text in zip(pdf["rk"], pdf["doc_id"], pdf["text"]):
                cuts = cut_points(text, chunk, overlap)
                rows = []
                for i, a in enumerate(cuts):
                    last = i + 1 == len(cuts)
                    end = len(text) if last else cuts[i + 1] + overlap
                    rows.append((key, doc_id, i, len(cuts), 0 if last else cuts[i + 1] - a, text[a:end]))
                yield pd.DataFrame(rows, columns=["rk", "doc_id", "chunk", "n_chunks", "step", "text"])
    return run


def _pretokenise(rank_file: str | None, overlap: int):
    """Boundaries of each chunk: those in the head that the predecessor also covers, and those in the own overlap."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rx = bpe.coder(rank_file).regex
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                b = boundaries(rx, r.text)
                tail = b[b >= r.step] if r.step else b[:0]
                out.append((r.rk, r.chunk, len(r.text), r.step, b[b <= overlap].tolist(), tail.tolist()))
            yield pd.DataFrame(out, columns=["rk", "chunk", "size", "step", "head", "tail"])
    return run


def _stitches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            cut = stitch(np.asarray(r.tail, np.int64), r.size, np.asarray(r.next_head, np.int64), r.step) if r.step else r.size
            out.append((r.rk, r.chunk, cut))
        yield pd.DataFrame(out, columns=["rk", "chunk", "stop"])


def _encode_chunks(rank_file: str | None):
    """Ids of the pieces between a chunk's stitch with its predecessor and that with its successor."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = bpe.coder(rank_file)
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                ids: list[int] = []
                for m in c.regex.finditer(r.text, r.begin):
                    if m.start() >= r.stop:
                        break
                    ids += c.encode_piece(m.group())
                out.append((r.rk, r.doc_id, r.chunk, r.n_chunks, np.asarray(ids, "<u4").tobytes()))
            yield pd.DataFrame(out, columns=["rk", "doc_id", "chunk", "n_chunks", "ids"])
    return run


def encode(docs: DataFrame, scratch: Scratch, rank_file: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP,
           finish=as_coded, schema: str = CODED) -> DataFrame:
    """(rk, doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit numbers, one row per input row.

    ``finish`` (rank file, list of (rk, doc_id, ids)) makes other output rows
    of ``schema`` in the worker that has the ids.  Texts of one chunk are encoded where they are read.  Longer ones become
    chunk rows that are dealt out by (row, chunk); small rows of boundaries
    find the stitches; the parts of a text meet again as ids.
    """
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("rk"))
    small = F.length("text") <= chunk + overlap
    whole = rows.where(small).mapInPandas(_encode_whole(rank_file, finish), schema)
    parts = (rows.where(~small).mapInPandas(_split(chunk, overlap), "rk long, doc_id long, chunk int, n_chunks int, step int, text string")
             .repartition("rk", "chunk"))
    parts = scratch.save(parts, "chunks")
    marks = parts.mapInPandas(_pretokenise(rank_file, overlap),
                              "rk long, chunk int, size int, step int, head array<int>, tail array<int>")
    w = Window.partitionBy("rk").orderBy("chunk")
    marks = marks.withColumn("next_head", F.lead("head").over(w)).drop("head")
    stops = marks.mapInPandas(_stitches, "rk long, chunk int, stop int")
    # a chunk begins where its predecessor stopped; places are relative to the own start
    begins = (stops.join(parts.select("rk", "chunk", "step"), ["rk", "chunk"])
              .select("rk", (F.col("chunk") + 1).alias("chunk"), (F.col("stop") - F.col("step")).alias("begin")))
    owned = (parts.join(stops, ["rk", "chunk"]).join(begins, ["rk", "chunk"], "left")
             .withColumn("begin", F.coalesce("begin", F.lit(0))))
    coded = owned.mapInPandas(_encode_chunks(rank_file), "rk long, doc_id long, chunk int, n_chunks int, ids binary")
    joined = (coded.groupBy("rk").agg(F.first("doc_id").alias("doc_id"),
                                      F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
              .select("rk", "doc_id", F.expr("aggregate(parts, cast('' as binary), (a, p) -> a || p.ids)").alias("ids")))
    return whole.unionByName(joined.mapInPandas(_finish_joined(rank_file, finish), schema))


def decode(coded: DataFrame, rank_file: str | None = None) -> DataFrame:
    """Adds ``decoded`` (raw bytes) to rows with ``ids``."""
    @F.pandas_udf("binary")
    def raw(ids: pd.Series) -> pd.Series:
        c = bpe.coder(rank_file)
        return ids.map(lambda b: c.decode(np.frombuffer(b, "<u4").tolist()))
    return coded.withColumn("decoded", raw("ids"))


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(rank_file: str | None, rows: list[tuple]) -> pd.DataFrame:
    """Digests of ids and of the bytes they decode to."""
    c = bpe.coder(rank_file)
    out = []
    for _, doc_id, ids in rows:
        ids = ids.tolist()
        text = " ".join(map(c.names.__getitem__, ids))
        out.append((doc_id, len(ids), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()))
    return pd.DataFrame(out, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, Scratch(spark, "op8"), finish=digests, schema=DIGESTS)


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
ORACLE: dict[str, str] = {}
