"""Byte-level BPE: corpus-level merge replay over the distinct pieces of many documents.

A task gathers documents, splits them by the pattern and keeps every distinct
piece once. The pieces' bytes lie in one array. An inverted index leads from
a pair's merge rank to the places where the pair stands; ranks are applied in
order, each to all its places at once, and only the two neighbours of a place
get a new pair and a new index entry. The merged pieces are then spread back
over the documents. Nothing is shuffled: a task's documents are its corpus.

A piece that is a token itself is that token, as in the rank file's usual
reader. A new pair of an earlier rank than the merge that made it is applied
next, before later ranks. Should it arise in a piece with several places of
that merge, the order between them matters, and the piece is encoded alone.

Defined results: a null or empty text has no ids and decodes to no bytes.
Rows keep their order and repeated rows are encoded alike. Other columns are
not read by ``bpe_encode``.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from playstats.llm.common import prepare, released, ship, text_column, unpack

#: Bytes of text whose pieces are merged together.
CORPUS_BYTES = 4 << 20
#: Ranks whose index entries are sorted together.
BAND_BITS = 8
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 token, space, rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Tokens as arrays: their bytes, and the sorted pairs that merge into one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        by_id = [b""] * size
        for token, rank in ranks.items():
            by_id[rank] = token
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[p] for p in self.pairs.tolist()], np.int32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that merges each pair, NONE where none does."""
        pairs = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.merged[at], NONE)

    def greedy(self, piece: bytes) -> list[int]:
        """One piece alone: the pair of lowest rank, leftmost first, until none is left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
            if rank == NONE:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids`` one after another."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ends):
            return np.empty(0, np.uint8)
        return self.bytes[np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + lengths, lengths)]


class _Replay:
    """Merges over the concatenated bytes of distinct pieces."""

    def __init__(self, vocabulary: Vocabulary, data: np.ndarray, ends: np.ndarray):
        self.v, n = vocabulary, len(data)
        self.token = vocabulary.of_byte[data]
        self.next = np.arange(1, n + 1, dtype=np.int64)
        self.next[ends - 1] = -1
        self.prev = np.arange(-1, n - 1, dtype=np.int64)
        self.prev[np.concatenate([[0], ends[:-1]])] = -1
        self.rank = np.full(n, NONE, np.int32)
        inner = np.flatnonzero(self.next >= 0)
        self.rank[inner] = vocabulary.pair_ranks(self.token[inner], self.token[inner + 1])
        self.piece = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        self.odd: list[np.ndarray] = []  # pieces to be encoded alone

    def run(self) -> None:
        """Apply all ranks in order, a band of neighbouring ranks at a time."""
        bands: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def file(places: np.ndarray) -> None:
            places = places[self.rank[places] != NONE]
            if not len(places):
                return
            band = self.rank[places] >> BAND_BITS
            order = np.argsort(band, kind="stable")
            places, band = places[order], band[order]
            cuts = np.flatnonzero(np.diff(band)) + 1
            for part, b in zip(np.split(places, cuts), band[np.concatenate([[0], cuts])].tolist(), strict=True):
                if b not in bands:
                    bands[b] = []
                    heapq.heappush(waiting, b)
                bands[b].append(part)

        file(np.arange(len(self.rank)))
        while waiting:
            band = heapq.heappop(waiting)
            file(self._band(band, np.concatenate(bands.pop(band))))

    def _band(self, band: int, places: np.ndarray) -> np.ndarray:
        """Apply the ranks of one band; the places of new pairs that belong to later ones."""
        index: dict[int, list[np.ndarray]] = {}  # the inverted index of this band
        ranks: list[int] = []
        later: list[np.ndarray] = []

        def enter(places: np.ndarray) -> None:
            rank = self.rank[places]
            if len(places) > 1:
                order = np.argsort(rank, kind="stable")
                places, rank = places[order], rank[order]
                cuts = np.flatnonzero(np.diff(rank)) + 1
                parts, firsts = np.split(places, cuts), rank[np.concatenate([[0], cuts])].tolist()
            else:
                parts, firsts = [places], rank.tolist()
            for part, r in zip(parts, firsts, strict=True):
                if r not in index:
                    index[r] = []
                    heapq.heappush(ranks, r)
                index[r].append(part)

        places = places[self.rank[places] >> BAND_BITS == band]
        if len(places):
            enter(places)
        while ranks:
            r = heapq.heappop(ranks)
            entries = index.pop(r)
            at = entries[0] if len(entries) == 1 else np.concatenate(entries)
            at = np.unique(at[self.rank[at] == r])
            if not len(at):
                continue
            new = self._merge(r, at)
            new = new[self.rank[new] != NONE]
            if len(new):
                here = self.rank[new] >> BAND_BITS <= band
                if here.any():
                    enter(new[here])
                    new = new[~here]
                later.append(new)
        return np.concatenate(later) if later else np.empty(0, np.int64)

    def _merge(self, r: int, at: np.ndarray) -> np.ndarray:
        """Merge the pairs of rank r at the places ``at`` (in order); the places of the new pairs."""
        right = self.next[at]
        touching = right[:-1] == at[1:]
        if touching.any():  # x x x: leftmost first, so every other place of a run
            start = np.concatenate([[True], ~touching])
            number = np.arange(len(at))
            at = at[(number - np.maximum.accumulate(np.where(start, number, 0))) % 2 == 0]
            right = self.next[at]
        after = self.next[right]
        self.token[at] = r
        self.token[right] = -1
        self.rank[right] = NONE
        self.next[at] = after
        inner = after >= 0
        self.prev[after[inner]] = at[inner]
        before = self.prev[at]
        touched = np.concatenate([before[before >= 0], at])
        follow = self.next[touched]
        rank = np.full(len(touched), NONE, np.int32)
        some = follow >= 0
        rank[some] = self.v.pair_ranks(self.token[touched[some]], self.token[follow[some]])
        self.rank[touched] = rank
        early = rank < r
        if early.any():
            pieces = self.piece[at]
            several = pieces[1:][pieces[1:] == pieces[:-1]]
            odd = early & np.isin(self.piece[touched], several)
            if odd.any():
                self.odd.append(self.piece[touched[odd]])
        return np.unique(touched)


def encode_pieces(vocabulary: Vocabulary, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct pieces one after another, and how many each piece has."""
    raw = pieces.cast(pa.large_binary())
    values = raw.to_pylist()
    whole = np.fromiter((vocabulary.ranks.get(p, -1) for p in values), np.int32, len(values))
    open_at = np.flatnonzero(whole < 0)
    counts = np.ones(len(values), np.int64)
    if not len(open_at):
        return whole, counts
    data = np.frombuffer(b"".join([values[i] for i in open_at.tolist()]), np.uint8)
    ends = np.cumsum([len(values[i]) for i in open_at.tolist()])
    replay = _Replay(vocabulary, data, ends)
    replay.run()
    live = replay.token >= 0
    merged, owner = replay.token[live], open_at[replay.piece[live]]
    if replay.odd:
        odd = np.unique(open_at[np.concatenate(replay.odd)])
        usual = ~np.isin(owner, odd)
        again = [vocabulary.greedy(values[i]) for i in odd.tolist()]
        merged = np.concatenate([merged[usual], *[np.array(a, np.int32) for a in again]])
        owner = np.concatenate([owner[usual], np.repeat(odd, [len(a) for a in again])])
    closed = np.flatnonzero(whole >= 0)
    owner = np.concatenate([owner, closed])
    ids = np.concatenate([merged, whole[closed]])[np.argsort(owner, kind="stable")]
    counts = np.bincount(owner, minlength=len(values))
    return ids, counts


def encode_texts(vocabulary: Vocabulary, pattern, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and how many each text has. ``pattern`` is compiled."""
    # one text's pieces at a time are Python strings
    split = [pa.array(pattern.findall(t), pa.large_string()) for t in texts]
    per_text = np.array([len(s) for s in split], np.int64)
    if not per_text.sum():
        return np.empty(0, np.int32), per_text
    flat = pc.dictionary_encode(pa.concat_arrays(split))
    del split
    codes = flat.indices.to_numpy(zero_copy_only=False)
    ids, counts = encode_pieces(vocabulary, flat.dictionary)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    sizes = counts[codes]
    ends = np.cumsum(sizes)
    out = ids[np.arange(ends[-1]) + np.repeat(starts[codes] - ends + sizes, sizes)]
    text_ends = np.concatenate([[0], ends])[np.cumsum(per_text)]
    return out, np.diff(text_ends, prepend=0)


def _encoded(docs: DataFrame, rank_file: str, pattern: str, id_col: str, text_col: str, corpus_bytes: int, output, schema: str) -> DataFrame:
    """Rows of ``schema``; ``output`` makes their columns after the id from (vocabulary, ids of all texts, counts)."""
    spark = prepare(docs.sparkSession)
    shared = ship(spark, Vocabulary(read_ranks(rank_file)))  # as large as the rank file allows

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        compiled, vocabulary = regex.compile(pattern), unpack(shared)
        ids, texts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            tokens, counts = encode_texts(vocabulary, compiled, texts)
            made = output(vocabulary, tokens.astype(np.int32), counts)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *made.values()], names=["id", *made])

        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), text_column(batch, "text").to_pylist(), strict=True):
                ids.append(key)
                texts.append(text)
                held += len(text)
                if held >= corpus_bytes:
                    yield flush()
                    ids, texts, held = [], [], 0
        if ids:
            yield flush()

    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return plain.mapInArrow(released(encode), f"id bigint, {schema}").withColumnRenamed("id", id_col)


def _id_lists(vocabulary: Vocabulary, tokens: np.ndarray, counts: np.ndarray) -> dict[str, pa.Array]:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return {"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens))}


def _round_trip(vocabulary: Vocabulary, tokens: np.ndarray, counts: np.ndarray) -> dict[str, pa.Array]:
    lists = _id_lists(vocabulary, tokens, counts)
    ends, data = (4 * np.cumsum(counts)).tolist(), tokens.astype("<u4").tobytes()
    packed = pa.array([data[a:b] for a, b in zip([0, *ends], ends)], pa.binary())
    return lists | {"packed_ids": packed, "decoded": pa.array(decode_lists(vocabulary, lists["ids"]), pa.binary())}


def bpe_encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", corpus_bytes: int = CORPUS_BYTES) -> DataFrame:
    """One row per document: id and ``ids``, an array of token ids."""
    return _encoded(docs, rank_file, pattern, id_col, text_col, corpus_bytes, _id_lists, "ids array<int>")


def bpe_round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", corpus_bytes: int = CORPUS_BYTES) -> DataFrame:
    """``bpe_encode``, and the ids decoded again, in one pass of one worker.

    Beside ``ids`` there are ``packed_ids``, the ids as little-endian unsigned
    32-bit integers, and ``decoded``, the bytes that the ids stand for.
    """
    return _encoded(docs, rank_file, pattern, id_col, text_col, corpus_bytes, _round_trip, "ids array<int>, packed_ids binary, decoded binary")


def decode_lists(vocabulary: Vocabulary, lists: pa.Array) -> list[bytes]:
    """The bytes of each list of ids."""
    ids = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(counts).tolist()
    return [vocabulary.decode(ids[a:b]).tobytes() for a, b in zip([0, *ends], ends)]


def bpe_decode(encoded: DataFrame, rank_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: id, ``ids`` and ``decoded``, the bytes that the ids stand for."""
    spark = prepare(encoded.sparkSession)
    shared = ship(spark, Vocabulary(read_ranks(rank_file)))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = unpack(shared)
        for batch in batches:
            decoded = decode_lists(vocabulary, batch.column("ids"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], names=["id", "ids", "decoded"])

    plain = encoded.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    return plain.mapInArrow(released(decode), "id bigint, ids array<int>, decoded binary").withColumnRenamed("id", id_col)
