"""Packing of token sequences by Karmarkar-Karp multiway differencing.

A task reads its documents in order. Tokens of a document beyond a window are cut into full windows; what is left of
each document is one piece, and the pieces of a group of windows are placed whole by differencing: each piece is a
partial partition with all windows but one empty, and the two partial partitions of the largest imbalance are merged,
large sums of one with small sums of the other, until one is left. Where a window then exceeds the capacity, there is
one window more, and the pieces are placed anew. The near-equal windows have some room left: it is filled with tokens
of the documents that come next, so only these are cut, and nothing is padded.

At a task's end nothing comes next, and the emptiest windows are cut up to fill the others. At most one sequence of a
task is padded. Tasks share nothing, so nothing is shuffled.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import Memo, slices, texts

CAPACITY = 2048
#: Windows of a group.
GROUP = 64
#: The id after each document.
END = 1
END_BYTES = END.to_bytes(4, "little")
#: Pieces of a batch that is handed on, and ids where these are: both sides hold batches whole.
BATCH_PIECES, BATCH_IDS = 10_000, 1 << 18
#: Words whose ids a Python worker remembers.
REMEMBERED = 100_000

#: The settings of a tokenizer file under which _NARROW stands for its pattern.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
KNOWN_SETTINGS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": KNOWN_PATTERN}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
#: That pattern, restated for lower-case texts of U+0000 to U+00FF only, where the classes are short.
_LETTER, _NUMBER, _SPACE = "a-zA-ZªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
_NARROW = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_NUMBER}{_LETTER}]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from U+0100 on."""
    fresh = count(256)
    return [chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else chr(next(fresh)) for b in range(256)]


class Words:
    """Ids of texts by a tokenizer file, without special tokens of its own accord.

    Where the file has the known settings, words of narrow texts are split here and their ids remembered; all else is
    the library's.
    """

    def __init__(self, data: str):
        file = json.loads(data)
        self.known_file = all(file.get(k) == v for k, v in KNOWN_SETTINGS.items()) and file.get("post_processor") is None
        self.tokenizer = Tokenizer.from_str(data)
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(_byte_letters()))
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        #: The ids of words, as 32-bit numbers.
        self.known = Memo(self.word, REMEMBERED)

    def word(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [x.id for x in self.model.tokenize(word)]).tobytes()

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text, then END."""
        try:
            text.encode("latin-1")
            narrow = self.known_file and not any(x in text for x in self.special)
        except UnicodeEncodeError:
            narrow = False
        if not narrow:
            return np.array([*self.tokenizer.encode(text, add_special_tokens=False).ids, END], dtype="<u4")
        known = self.known
        return np.frombuffer(b"".join([known[x] for x in _NARROW.findall(text.lower())]) + END_BYTES, dtype="<u4")


#: The tokenizers of this Python worker.
_MADE: dict[str, Words] = {}

#: A window of a partial partition: its sum and its pieces.
Window = tuple[int, list[int]]


def difference(lengths: list[int], windows: int) -> list[list[int]]:
    """The places in lengths of each window's items, by Karmarkar and Karp's largest differencing method."""
    order = count()
    # A partial partition lists its windows that are not empty, by falling sum.
    heap: list[tuple[int, int, list[Window]]] = [(-x, next(order), [(x, [i])]) for i, x in enumerate(lengths)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        apart = windows - max(len(a), len(b))
        if len(b) > len(a):
            a, b = b, a
        # The largest of b go to the empty windows of a, the others to a's smallest, the larger to the smaller.
        alone, joined = b[:apart], b[apart:]
        kept = a[: len(a) - len(joined)]
        merged = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(reversed(a[len(a) - len(joined) :]), joined)]
        both = sorted(kept + alone + merged, key=lambda x: -x[0])
        least = both[-1][0] if len(both) == windows else 0
        heapq.heappush(heap, (least - both[0][0], next(order), both))
    return [x[1] for x in heap[0][2]] if heap else []


#: doc_id, start in the document, ids, tokens of the document.
Piece = tuple[int | None, int, np.ndarray, int]


def place(pieces: list[Piece], capacity: int) -> list[list[Piece]]:
    """The pieces, whole, in near-equal windows of the capacity at most, as few as differencing finds by adding one at a time."""
    sizes = [len(x[2]) for x in pieces]
    windows = -(-sum(sizes) // capacity)
    while pieces:
        places = difference(sizes, windows)
        if all(sum(sizes[i] for i in own) <= capacity for own in places):
            return [[pieces[i] for i in own] for own in places]
        windows += 1
    return []


def take(source: deque[Piece], tokens: int) -> list[Piece]:
    """The first tokens of a source, as far as it goes; what is left of a piece stays in it."""
    out: list[Piece] = []
    while tokens and source:
        doc, start, ids, total = source.popleft()
        if len(ids) > tokens:
            source.appendleft((doc, start + tokens, ids[tokens:], total))
            ids = ids[:tokens]
        out.append((doc, start, ids, total))
        tokens -= len(ids)
    return out


def tokens_of(pieces: list[Piece]) -> int:
    return sum(len(x[2]) for x in pieces)


def fill(windows: list[list[Piece]], source: deque[Piece], capacity: int) -> list[list[Piece]]:
    """The windows with their room filled from the source, which is less than that, then from the emptiest windows.

    All are full but one at most.
    """
    left = deque(sorted(windows, key=tokens_of))
    out = []
    while left:
        own = left.pop()
        while (room := capacity - tokens_of(own)) and (source or left):
            if not source:
                source.extend(left.popleft())
            own += take(source, room)
        out.append(own)
    if source:
        out.append(take(source, capacity))
    return out


def pack(documents: Iterator[tuple[int | None, np.ndarray]], capacity: int = CAPACITY, group: int = GROUP) -> Iterator[list[Piece]]:
    """The sequences of documents (doc_id, ids): each a list of pieces."""
    source: deque[Piece] = deque()
    more = True

    def read() -> bool:
        for doc, ids in documents:
            if len(ids):
                source.append((doc, 0, ids, len(ids)))
                return True
        return False

    while more or source:
        pieces: list[Piece] = []
        tokens = 0
        while tokens < group * capacity and (source or (more and (more := read()))):
            doc, start, ids, total = source.popleft()
            whole = len(ids) - len(ids) % capacity
            for at in range(0, whole, capacity):
                yield [(doc, start + at, ids[at : at + capacity], total)]
            if len(ids) > whole:
                pieces.append((doc, start + whole, ids[whole:], total))
                tokens += len(ids) - whole
        windows = place(pieces, capacity)
        room = len(windows) * capacity - tokens
        while more and tokens_of(source) < room:
            more = read()
        if more:
            for own in windows:
                own += take(source, capacity - tokens_of(own))
        else:
            windows = fill(windows, source, capacity)
        yield from windows


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _packed(docs: DataFrame, path: str, capacity: int, schema: str, with_ids: bool) -> DataFrame:
    with open(path, encoding="utf-8") as file:
        data = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _MADE:
            _MADE[path] = Words(data.value)
        words = _MADE[path]

        def documents() -> Iterator[tuple[int | None, np.ndarray]]:
            for batch in slices(batches):
                for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
                    yield doc, words.ids(text)

        base = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        held = 0
        for k, sequence in enumerate(pack(documents(), capacity)):
            offset = 0
            for doc, start, ids, total in sequence:
                rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, base + k, offset, *([ids] if with_ids else [])))
                offset += len(ids)
            held += offset * with_ids
            if len(rows) > BATCH_PIECES or held > BATCH_IDS:
                yield _rows(rows, with_ids)
                rows, held = [], 0
        yield _rows(rows, with_ids)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _rows(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    columns = [pa.array([x[i] for x in rows], pa.int64()) for i in range(7)]
    if with_ids:
        ends = np.cumsum([0, *(len(x[7]) for x in rows)], dtype=np.int32)
        flat = np.concatenate([x[7] for x in rows] or [np.empty(0, "<u4")]).astype(np.int32)
        columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
    return pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every row of docs (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of the tokenizer file, then END; null is the empty text, of END alone. Each id is in
    exactly one piece; a sequence's pieces follow each other from offset 0 without gaps and have capacity ids at most.
    Rows that repeat a doc_id, or have none, are documents of their own. An empty table gives no rows. Other columns
    are not read, whatever their names. A text of any length is cut into as many pieces as it takes. Sequence ids are
    unique, not dense: the partition's number and a count in it.
    """
    return _packed(docs, path, capacity, SCHEMA, False)


def packed_ids(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """As pack_documents, with each piece's ids."""
    return _packed(docs, path, capacity, f"{SCHEMA}, ids array<int>", True)
