"""Byte-level BPE encoding and decoding by overlapping chunks.

Texts longer than a chunk are cut into chunks that overlap, which are split into pre-tokens and encoded each by itself:
those of a text in its own task, so that it need not move, and those of texts beyond a span, which are larger, side by
side in several tasks. A chunk's first boundaries may be wrong, as it can start within a pre-token, and so may be those
that touch its end. The pattern looks only ahead, so from a boundary that two chunks share they agree: there the later
chunk takes over. Each chunk finds that place by itself, as it holds the next one's beginning. What is stitched in the
end are ids. A text in which two chunks share no boundary (a run of letters longer than the overlap) is encoded whole.
Decoding joins the raw bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, materialise, slices, texts

CHUNK = 1 << 12
OVERLAP = 1 << 8
#: The same for chunks that are spread over tasks: those of texts that are longer than one of them.
SPAN = 1 << 16
SPAN_OVERLAP = 1 << 10
#: Code points that decide where a pre-token ends, at most, beyond those of the pre-token.
SURE = 3
#: Pre-tokens whose ids a Python worker remembers.
REMEMBERED = 100_000

#: Fixed value: the pattern of the rank files.
KNOWN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: That pattern, restated for texts of U+0000 to U+00FF only, where the classes are short.
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
_NARROW = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_NUMBER}{_LETTER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, to be broadcast."""
    with open(path, "rb") as file:
        return file.read()


def is_narrow(text: str) -> bool:
    """Whether all code points are below U+0100."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Coder:
    """Encodes and decodes with the ranks of one file."""

    def __init__(self, data: bytes, pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.wide = regex.compile(pattern)
        self.known_pattern = pattern == KNOWN_PATTERN
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.digits_of = {rank: str(rank) for rank in ranks.values()}
        #: The ids of pre-tokens.
        self.known = Memo(lambda piece: tuple(self.encoding.encode_ordinary(piece)), REMEMBERED)

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text, in order: the pattern's matches. Under the known pattern they are the whole text."""
        if self.known_pattern and is_narrow(text):
            return _NARROW.findall(text)
        return [m[0] for m in self.wide.finditer(text)]

    def places(self, text: str) -> list[tuple[int, str]]:
        """The pre-tokens with where they start."""
        if self.known_pattern:
            pieces = self.pieces(text)
            return list(zip(starts_of(pieces, 0), pieces))
        return [(m.start(), m[0]) for m in self.wide.finditer(text)]

    def encode(self, text: str) -> list[int]:
        return self.ids(self.pieces(text))

    def ids(self, pieces: list[str]) -> list[int]:
        known = self.known
        return list(chain.from_iterable([known[x] for x in pieces]))

    def decode(self, ids: list[int]) -> bytes:
        own = self.bytes_of
        return b"".join([own[x] for x in ids])

    def digits(self, ids: list[int]) -> str:
        own = self.digits_of
        return ",".join([own[x] for x in ids])


def starts_of(pieces: list[str], at: int) -> list[int]:
    """Where each piece starts, if the first starts at at."""
    out = []
    for x in pieces:
        out.append(at)
        at += len(x)
    return out


def shared_start(own: list[tuple[int, str]], following: list[tuple[int, str]], sure: int) -> int | None:
    """The first place, up to sure, where a piece of both begins."""
    begins = {at for at, _ in following}
    return next((at for at, _ in own if at in begins and at <= sure), None)


def takes_over(coder: Coder, part: str, places: list[tuple[int, str]], chunk: int) -> int | None:
    """Where in the next chunk that chunk takes over from this one (part: with the overlap); None if they share no boundary."""
    # Pieces that end within SURE of the part's end may be cut short by it, so the last start that counts is before.
    starts = [(at - chunk, x) for at, x in places if at >= chunk and at + len(x) <= len(part) - SURE]
    return shared_start(starts, coder.places(part[chunk:]), len(part))


def encode_chunk(coder: Coder, part: str, chunk: int, last: bool, overlap: int = OVERLAP) -> tuple[list[int], list[int], list[int], int | None]:
    """Ids of a chunk's pre-tokens up to where the next one takes over, and what the one before needs to stitch.

    part: the chunk's text, with the overlap unless it is the last. Returns the ids, the places in the overlap's length
    at which pre-tokens start and how many ids are before each, and the place in the next chunk where that takes over:
    None if the two share no boundary.
    """
    places = coder.places(part)
    over = None
    if not last:
        over = takes_over(coder, part, places, chunk)
        places = [x for x in places if over is not None and x[0] < chunk + over]
    ids = [coder.known[x] for _, x in places]
    most = max(len(part) - chunk, overlap)
    starts, before, n = [], [], 0
    for (at, _), own in zip(places, ids):
        if at > most:
            break
        starts.append(at)
        before.append(n)
        n += len(own)
    return list(chain.from_iterable(ids)), starts, before, over


def stitch(chunks: Iterable[tuple[list[int], list[int], list[int], int | None]]) -> list[int] | None:
    """The ids of a text from those of its chunks in order, from each those from where it takes over; None if two share no boundary."""
    out: list[int] = []
    over: int | None = 0
    for k, (ids, starts, before, then) in enumerate(chunks):
        known = dict(zip(starts, before))
        if k and (over is None or (over not in known and ids)):
            return None
        out += ids[known.get(over, 0) if k else 0 :]
        over = then
    return out


def encode_text(coder: Coder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """The ids of a text by chunks, in one task; of one whose chunks share no boundary by the whole."""
    if len(text) <= chunk + overlap:
        return coder.encode(text)
    ids = stitch(encode_chunk(coder, text[at : at + chunk + overlap], chunk, at + chunk >= len(text), overlap) for at in range(0, len(text), chunk))
    return coder.encode(text) if ids is None else ids


RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
IDS = "doc_id long, ids array<int>"


def _coders(docs: DataFrame, path: str, pattern: str):
    data = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def coder() -> Coder:
        key = f"{path} {pattern}"
        if key not in _MADE:
            _MADE[key] = Coder(data.value, pattern)
        return _MADE[key]

    return coder


#: The coders of this Python worker.
_MADE: dict[str, Coder] = {}


def _digest(coder: Coder, ids: list[int]) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(coder.digits(ids).encode()).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()


def _encoded(docs: DataFrame, path: str, pattern: str, schema: str, result, chunk: int, overlap: int, span: int, span_overlap: int) -> DataFrame:
    """result(coder, ids) for the ids of each row. Texts of up to span code points stay in their task."""
    coder_of = _coders(docs, path, pattern)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = [x.split()[0] for x in schema.split(", ")]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of()
        for batch in slices(batches):
            rows = [result(coder, encode_text(coder, x, chunk, overlap)) for x in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([x[k] for x in rows], t) for k, t in enumerate(_types(schema)))], names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            for doc, entry, text in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "entry", "text"))):
                starts = range(0, len(text), span)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(starts), pa.int64()), pa.array([entry] * len(starts), pa.int64()), pa.array(range(len(starts)), pa.int64()), pa.array([at + span >= len(text) for at in starts]), pa.array([text[at : at + span + span_overlap] for at in starts], pa.string())],
                    ["doc_id", "entry", "k", "last", "part"],
                )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of()
        for batch in slices(batches, 16):
            out = [encode_chunk(coder, x, span, last, span_overlap) for x, last in zip(batch.column("part").to_pylist(), batch.column("last").to_pylist())]
            lists = [pa.array([x[i] for x in out], pa.list_(pa.int32())) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("doc_id", "entry", "k", "last")), *lists, pa.array([x[3] for x in out], pa.int32())], ["doc_id", "entry", "k", "last", "ids", "starts", "before", "over"])

    def join(key, group):
        """A text's chunks in order: from each the ids from where it takes over."""
        rows = sorted(group.to_pylist(), key=lambda x: x["k"])
        ids = stitch((x["ids"], x["starts"], x["before"], x["over"]) for x in rows)
        whole = ids is None
        out = [None] * (len(names) - 1) if whole else result(coder_of(), ids)
        columns = [pa.array([rows[0]["doc_id"]], pa.int64()), *(pa.array([x], t) for x, t in zip(out, _types(schema))), pa.array([rows[0]["entry"]], pa.int64()), pa.array([whole])]
        return pa.Table.from_arrays(columns, [*names, "entry", "whole"])

    cuts = f"length(text) > {span + span_overlap}"
    short = docs.filter(f"text is null or not {cuts}").mapInArrow(whole, schema)
    long = materialise(docs.filter(cuts).withColumn("entry", F.monotonically_increasing_id()))
    parts = long.mapInArrow(cut, "doc_id long, entry long, k long, last boolean, part string").repartition(max(docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "entry", "k")
    encoded = parts.mapInArrow(encode, "doc_id long, entry long, k long, last boolean, ids array<int>, starts array<int>, before array<int>, over int")
    joined = materialise(encoded.groupBy("entry").applyInArrow(join, f"{schema}, entry long, whole boolean"))
    unshared = long.join(joined.filter("whole").select("entry"), "entry", "left_semi").select("doc_id", "text")
    return short.unionByName(joined.filter("not whole").select(*names)).unionByName(unshared.mapInArrow(whole, schema))


def _types(schema: str) -> list[pa.DataType]:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    return [kinds[x.split()[1]] for x in schema.split(", ")[1:]]


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, span: int = SPAN, span_overlap: int = SPAN_OVERLAP) -> DataFrame:
    """doc_id, ids of every row of docs (doc_id, text); null is the empty text, which has no ids.

    path: a file of ranks; pattern: what splits a text into pre-tokens, with no look behind and looking SURE code points
    ahead at most. Special tokens are ordinary text. Each row is encoded by itself: repeated rows, ties and null
    identifiers give a row each. Texts of any length are encoded whole, by chunks, those of over span code points in several tasks. An empty
    table gives no rows. Other columns are not read, whatever their names.
    """
    return _encoded(docs, path, pattern, IDS, lambda coder, ids: (ids,), chunk, overlap, span, span_overlap)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, bytes (raw, as ids may end within a character) of each row of encoded (doc_id, ids); null as no ids.

    Each row is decoded by itself, so repeated rows, ties and null identifiers give a row each; ids of any number are
    decoded whole. An empty table gives no rows. Other columns are not read, whatever their names.
    """
    coder_of = _coders(encoded, path, pattern)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of()
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([coder.decode(x or []) for x in batch.column("ids").to_pylist()], pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(join, "doc_id long, bytes binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, span: int = SPAN, span_overlap: int = SPAN_OVERLAP) -> DataFrame:
    """As encode, with digests instead of the ids: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ids_sha256 is of the decimal ids joined by commas, decoded_sha256 of the bytes that the ids decode to.
    """
    return _encoded(docs, path, pattern, RESULT, _digest, chunk, overlap, span, span_overlap)
