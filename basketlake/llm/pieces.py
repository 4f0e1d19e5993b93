"""Operator 12: sentence-piece encoding that keeps the place of every piece in the source."""

from __future__ import annotations

import heapq
import re
from collections import Counter
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from basketlake.llm.common import table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Segments that a task remembers; the memory is emptied when it is full.
REMEMBERED = 300_000
#: Longer segments are merged with an agenda and not remembered.
SHORT, NEVER = 64, float("inf")
#: Kinds of characters by which texts are cut; more kinds make fewer different segments.
KINDS = 6
#: Fixed values of the model file: kinds of pieces, and the number of the kind of model that merges pairs.
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2


def _fields(data: bytes):
    """(number, value) of the fields of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size, at = (8, at) if key & 7 == 1 else (4, at) if key & 7 == 5 else number(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """A compiled character map: a double array over UTF-8 bytes, whose leaves point at replacement texts."""

    def __init__(self, data: bytes):
        size = int.from_bytes(data[:4], "little") if data else 0
        self.units = np.frombuffer(data, dtype="<u4", count=size // 4, offset=4).tolist() if data else []
        self.texts = data[4 + size :]
        self.begins = lru_cache(maxsize=1 << 16)(self._begins)

    def _path(self, data: bytes, start: int):
        """(end, leaf) for every byte from `start` on that keys go on with; leaf is -1 where no key ends."""
        at = 0
        for end in range(start, len(data)):
            unit = self.units[at]
            at ^= (unit >> 10 << ((unit & 512) >> 6)) ^ data[end]
            if at >= len(self.units) or self.units[at] & 0x800000FF != data[end]:
                return
            unit = self.units[at]
            yield end + 1, self.units[at ^ unit >> 10 << ((unit & 512) >> 6)] & 0x7FFFFFFF if unit >> 8 & 1 else -1

    def _begins(self, char: str) -> bool:
        data = char.encode("utf-8", "surrogatepass")
        return sum(1 for _ in self._path(data, 0)) == len(data)

    def longest(self, data: bytes, start: int) -> tuple[int, str]:
        """(end, replacement) of the longest key at that place of the data; (start, "") where none is."""
        end, leaf = max(((e, leaf) for e, leaf in self._path(data, start) if leaf >= 0), default=(start, -1))
        return end, self.texts[leaf : self.texts.index(b"\0", leaf)].decode() if leaf >= 0 else ""


def _cut(pieces: dict[str, float]) -> re.Pattern:
    """A pattern whose matches follow one another through any normal text and which no piece crosses.

    Characters that stand next to each other in a piece are of one kind, and so are those linked by others; spaces only
    go in front. The kinds with the most pieces are told apart, the others are taken together.
    """
    if any(b == SPACE != a for text in pieces for a, b in zip(text, text[1:], strict=False)):
        return re.compile("(?s:.+)")
    kind = {c: c for text in pieces if len(text) > 1 for c in text if c != SPACE}

    def of(c: str) -> str:
        while kind[c] != c:
            kind[c] = c = kind[kind[c]]
        return c

    joined = [text.lstrip(SPACE) for text in pieces]
    for text in joined:
        for a, b in zip(text, text[1:], strict=False):
            kind[of(a)] = of(b)
    weights = Counter(of(text[0]) for text in joined if text and text[0] in kind)
    groups: dict[str, str] = {}
    top = {c: c for c, _ in weights.most_common(KINDS)}
    for c in sorted(kind):
        groups[top.get(of(c), "")] = groups.get(top.get(of(c), ""), "") + c
    ordered = sorted(groups, key=lambda g: -weights[g])
    return re.compile("|".join(f"{SPACE}*[{re.escape(groups[g])}]+" for g in ordered) + f"|{SPACE}+|(?s:.)")


class Pieces:
    """A model file: the character map, the vocabulary with its merge order, and the spans of what it encodes."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        self.order: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: list[int] = []
        pieces, trainer, rules = [], {}, {}
        for field, value in _fields(data):
            if field == 1:
                pieces.append(dict(_fields(value)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        for i, piece in enumerate(pieces):
            text, kind = piece[1].decode(), piece.get(3, NORMAL)
            if kind == NORMAL:
                self.order[text] = -np.frombuffer(piece.get(2, bytes(4)), dtype="<f4").item()
                self.ids[text] = i
            elif kind == BYTE:
                self.bytes.append(i)
            elif kind == UNKNOWN:
                self.unknown = i
            elif kind != CONTROL:
                raise ValueError(f"pieces of kind {kind} are not supported")
        if trainer.get(3) != BPE or trainer.get(24) or not rules.get(5, 1) or len(self.bytes) not in (0, 256):
            raise ValueError("only models that merge pairs, with escaped white space in front of words, are supported")
        self.map = CharacterMap(rules.get(2, b""))
        self.prefix, self.trim = rules.get(3, 1), rules.get(4, 1)
        self.cut = _cut(self.order)
        self.processor = SentencePieceProcessor(model_file=path)
        self.known = _Memory(self)

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """(normal text, source): the place in the source's bytes of every character, and of the end.

        At each place the longest key of the character map is replaced; what no key begins with stays. Every character
        of a replacement comes from where its key begins. Then white space is trimmed if the model says so, a space is
        put in front, and spaces are shown as the model shows them.
        """
        if not text:
            return "", np.zeros(1, dtype=np.int64)
        if text.isascii():
            source = np.arange(len(text) + 1)
        else:
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
            widths = 1 + (codes >= 0x80) + (codes >= 0x800).astype(int) + (codes >= 0x10000)
            source = np.concatenate([[0], np.cumsum(widths)])
        begins = "".join(c for c in set(text) if self.map.units and self.map.begins(c))
        if begins:
            data, parts, places, done = text.encode("utf-8", "surrogatepass"), [], [], 0
            for hit in re.finditer(f"[{re.escape(begins)}]", text):
                at = hit.start()
                end, new = self.map.longest(data, int(source[at])) if at >= done else (0, "")
                if end > source[at]:
                    parts += [text[done:at], new]
                    places += [source[done:at], np.full(len(new), source[at])]
                    done = int(np.searchsorted(source, end))
            text, source = "".join([*parts, text[done:]]), np.concatenate([*places, source[done:]])
        if self.trim:
            text = text.rstrip(" ")
            blank = np.array([c == " " for c in text], dtype=bool)
            keep = ~blank | ~np.concatenate([[True], blank[:-1]])[: len(blank)]
            text = "".join(c for c, k in zip(text, keep, strict=True) if k)
            source = source[: len(keep) + 1][np.append(keep, True)]
        if self.prefix and text:
            text, source = " " + text, np.concatenate([source[:1], source])
        return text.replace(" ", SPACE), source

    def merged(self, segment: str) -> list[str]:
        """The segment as pieces: neighbours merge in the order of the vocabulary, the leftmost first."""
        parts, order = list(segment), self.order.get
        if len(parts) > SHORT:
            return self._merged_long(parts)
        orders = [order(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while orders and (least := min(orders)) != NEVER:
            i = orders.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del orders[i]
            if i:
                orders[i - 1] = order(parts[i - 1] + parts[i], NEVER)
            if i < len(orders):
                orders[i] = order(parts[i] + parts[i + 1], NEVER)
        return parts

    def _merged_long(self, parts: list[str | None]) -> list[str]:
        """The same with an agenda, whose time grows no faster than n log n."""
        before, after = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        agenda: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                order = self.order.get(text := parts[left] + parts[right])
                if order is not None:
                    heapq.heappush(agenda, (order, left, right, text))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, text = heapq.heappop(agenda)
            if parts[left] is None or after[left] != right or parts[left] + parts[right] != text:
                continue
            parts[left], parts[right] = text, None
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p is not None]

    def numbered(self, segment: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """(ids, characters covered) of the pieces of a segment; what is unknown is written as its bytes."""
        ids, sizes = [], []
        for piece in self.merged(segment):
            if piece in self.ids:
                ids.append(self.ids[piece])
                sizes.append(len(piece))
            elif self.bytes:
                own = piece.encode("utf-8", "replace")
                ids += [self.bytes[b] for b in own]
                sizes += [0] * (len(own) - 1) + [len(piece)]
            else:
                ids.append(self.unknown)
                sizes.append(len(piece))
        return tuple(ids), tuple(sizes)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, ends): the pieces of a text and the bytes of the source that each one covers."""
        normal, source = self.normalised(text)
        found = list(map(self.known.__getitem__, self.cut.findall(normal)))
        ids = np.fromiter(chain.from_iterable([f[0] for f in found]), dtype=np.int32)
        sizes = np.fromiter(chain.from_iterable([f[1] for f in found]), dtype=np.int64, count=len(ids))
        ends = np.cumsum(sizes)
        if not self.bytes and len(ids):
            first = np.concatenate([[True], (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)])
            ids, ends = ids[first], ends[np.concatenate([first[1:], [True]])]
            sizes = np.diff(ends, prepend=0)
        return ids, source[ends - sizes].astype(np.int32), source[ends].astype(np.int32)


class _Memory(dict):
    """(ids, characters covered) of the segments met so far."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, segment: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        found = self.pieces.numbered(segment)
        if len(segment) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[segment] = found
        return found


@lru_cache(maxsize=2)
def _pieces(path: str | None) -> Pieces:
    return Pieces(path or public_tokenizers.path(MODEL))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = list(accumulate(map(len, arrays), initial=0))
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(np.concatenate(arrays), type=pa.int32()))


def encoded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, starts, ends, decoded) of every whole text: its pieces, the bytes each covers, and the text back.

    Ids are those of the model's own library; piece i covers bytes starts[i] to ends[i] of the text in UTF-8, and the
    spans follow one another from 0 to its end. Of a character that is written as bytes, only the last byte covers
    it. A piece in front that holds nothing but the added space covers no byte. Null and empty texts have no pieces and decode to the
    empty text; repeated rows come back as often; an empty table gives no rows. Other columns are not read, whatever
    their names. A text and its lists have to fit in a task's memory; batches of texts are bounded by the session.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        pieces = _pieces(model)
        for batch in batches:
            found = [pieces.encode(t or "") for t in batch.column(1).to_pylist()] or [(np.zeros(0, dtype=np.int32),) * 3]
            back = pieces.processor.decode([ids.tolist() for ids, _, _ in found])[: batch.num_rows]
            ids, starts, ends = (_lists([f[i] for f in found])[: batch.num_rows] for i in range(3))
            columns = [batch.column(0), ids, starts, ends, pa.array(back, type=pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "starts", "ends", "decoded"])

    schema = f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>, decoded string"
    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def op12(spark, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
