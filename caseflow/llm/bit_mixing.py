"""Language-model scores by online logistic mixing of context bit predictors.

A text is its UTF-8 bytes and a closing zero byte, eight binary decisions a
byte.  For each decision one predictor per order (0 to 5 bytes of context)
looks up how often the bit was 0 and 1 in the training documents after the
same context and the same bits of the byte, by exact keys, so an unseen context
reads as unseen.  Their log-odds are added with weights from a
set that a gate selects (bit position, number of orders that were ever seen).  The
weights are learned online, one step per mini-batch, each n-gram predicted
without its own occurrence; an adaptive table over (last byte, predicted
log-odds) refines the result.  The sum over a text is its total log10
probability, or bits per byte.

Counts grow with the corpus and stay in the shared folder.  A block of documents
sends its distinct n-grams to ranges of the order (last context byte, the one
before it, ..., byte), and its distinct words to ranges of their hashes.  The
number of ranges follows the size of the input, and a sample sets their edges,
so a frequent context is cut over as many ranges as it needs.  Beyond FAN ranges
the way there has stations: a station gathers about FAN blocks' n-grams of one
group of ranges, merges them and sends them on to the groups within, so a
block or station sends to FAN places at most and the rows sent grow with the
text (times the number of stations on the way, 1 up to 8 GB, 2 up to 8 TB), not with
blocks times ranges.  A range holds all counts of all its contexts but of
those that an edge lies in; these are summed over the ranges by Spark and
joined to the ranges that they cut.  What a range makes of a block's n-grams and
words goes back the same way, one number each, to the block, where the
documents' sums are made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm.common import mix64, sliced, small_batches, words, write_once

ORDERS = 6
#: Bytes of text that are handled together.
BLOCK_BYTES = 3 << 19
#: n-grams of one step of the weights, and the rate of a step.
STEP, RATE = 1024, 0.5
APM_CELLS = 33
#: Text of one range of n-grams; the text and the n-grams that the ranges' edges are taken from.
SHARD_BYTES, SAMPLE_BYTES, SAMPLE_KEYS = 8 << 20, 16 << 20, 1_000_000
#: Groups of ranges that a block or a station sends to, at most.
FAN = 1024
_END = np.uint64(0x5851F42D4C957F2D)  # stands for the end token among the words' hashes


# Packing of arrays into binary columns ------------------------------------------------------------

def small(x: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest needs, the width first."""
    top = int(x.max()) if len(x) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def large(data: bytes) -> np.ndarray:
    """What ``small`` packed, as 64-bit numbers."""
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def by_context(key: np.ndarray) -> np.ndarray:
    """n-grams of ``six_grams`` with the last context byte first and the predicted byte last."""
    return key.byteswap() >> np.uint64(8) & np.uint64(0xFFFFFFFFFF00) | key & np.uint64(255)


def planes(key: np.ndarray) -> bytes:
    """Six-byte numbers, byte by byte: of ascending numbers the upper bytes compress well."""
    return np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ORDERS].T).tobytes()


def unplaned(data: bytes) -> np.ndarray:
    """What ``planes`` packed."""
    out = np.zeros((len(data) // ORDERS, 8), np.uint8)
    out[:, :ORDERS] = np.frombuffer(data, np.uint8).reshape(ORDERS, -1).T
    return out.view("<u8").ravel().astype(np.uint64)


def blocks(texts: list[bytes]) -> Iterator[slice]:
    """Slices of about BLOCK_BYTES."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= BLOCK_BYTES):
            size += len(texts[j])
            j += 1
        yield slice(i, j)
        i = j


def six_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, starts): for each byte, and a zero byte that closes each text, the last six bytes as a number."""
    data = np.frombuffer(b"".join(b"\0\0\0\0\0" + t + b"\0" for t in texts), np.uint8).astype(np.uint64)
    n = np.array([len(t) + 1 for t in texts], np.int64)
    key = data[5:].copy()
    for back in range(1, ORDERS):
        key |= data[5 - back:len(data) - back] << np.uint64(8 * back)
    # of each text, the places after its five leading zeros
    keep = np.ones(len(key), bool)
    begin = np.cumsum(n + 5) - (n + 5)
    for back in range(5):
        keep[(begin[1:] - 5 + back)] = False
    return key[keep], np.cumsum(n) - n


def summed(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of ``n`` (1 each by default)."""
    if n is None:
        keys = np.sort(keys)
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        return keys[at], np.diff(np.r_[at, len(keys)])
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(n[order], at) if len(at) else n[:0]


def merged(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, ascending, their sums of ``n``, and the place of each given key among them."""
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(n), len(distinct)).astype(np.int64), place


# The model ------------------------------------------------------------------------------------------

@dataclass
class Model:
    """Mixing weights by gate and the refining table; ``RangeModel`` adds the counts, and what is asked of them."""

    weights: np.ndarray = field(default_factory=lambda: np.full((8, ORDERS + 1, ORDERS), 0.3))
    apm: np.ndarray = field(default_factory=lambda: np.tile(
        1 / (1 + np.exp(-(np.arange(APM_CELLS) - APM_CELLS // 2) / 2.0)), (256, 1)))

    def mixed(self, odds: np.ndarray, gate: np.ndarray, k: int) -> np.ndarray:
        return np.clip((self.weights[k][gate].T * odds).sum(axis=0), -12, 12)

    def refined(self, key: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Probability of a 1: the mixer's and the refining table's, averaged."""
        at = np.clip(z * 2 + APM_CELLS // 2, 0, APM_CELLS - 1.001)
        low = at.astype(np.int64)
        last = self.last(key)
        table = self.apm[last, low] * (low + 1 - at) + self.apm[last, low + 1] * (at - low)
        return np.clip(0.5 * table + 0.5 / (1 + np.exp(-z)), 1e-6, 1 - 1e-6)

    def learn(self, key: np.ndarray, n: np.ndarray) -> None:
        """One online pass over n-grams with their counts: a step of the weights for each mini-batch."""
        order = np.argsort(mix64(key))
        for i in range(0, len(key), STEP):
            part, m = key[order[i:i + STEP]], n[order[i:i + STEP]]
            share = m / m.sum()
            for k in range(8):
                odds, gate, bit = self.inputs(part, k, 1)
                error = (bit - 1 / (1 + np.exp(-self.mixed(odds, gate, k)))) * share
                for g in np.unique(gate):
                    here = gate == g
                    self.weights[k, g] += RATE * (odds[:, here] * error[here]).sum(axis=1)

    def apm_counts(self, key: np.ndarray, n: np.ndarray) -> np.ndarray:
        """2 x 256 x cells: weighted ones, and all, by last byte and predicted log-odds."""
        out = np.zeros((2, 256 * APM_CELLS))
        last = self.last(key)
        for k in range(8):
            odds, gate, bit = self.inputs(key, k, 1)
            at = np.clip(self.mixed(odds, gate, k) * 2 + APM_CELLS // 2, 0, APM_CELLS - 1.001)
            low = at.astype(np.int64)
            for cell, weight in ((low, low + 1 - at), (low + 1, at - low)):
                place = last * APM_CELLS + cell
                out[0] += np.bincount(place, n * weight * bit, 256 * APM_CELLS)
                out[1] += np.bincount(place, n * weight, 256 * APM_CELLS)
        return out.reshape(2, 256, APM_CELLS)

    def log10(self, key: np.ndarray) -> np.ndarray:
        """log10 probability of each key's last byte after the five before."""
        out = np.zeros(len(key))
        for k in range(8):
            odds, gate, bit = self.inputs(key, k, 0)
            p = self.refined(key, self.mixed(odds, gate, k))
            out += np.log10(np.where(bit == 1, p, 1 - p))
        return out


@dataclass
class RangeModel(Model):
    """A model of the n-grams of one range, in the order of ``by_context``, by exact counts."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    levels: list = field(default_factory=list)  # of each order: the place of each key, counts by bits known

    @classmethod
    def of(cls, key: np.ndarray, n: np.ndarray, cut: dict[tuple[int, int], np.ndarray]) -> RangeModel:
        """From ascending distinct n-grams and their training counts; ``cut`` has (bytes, counts) of cut contexts."""
        levels = []
        for o in range(ORDERS):
            node = key >> np.uint64(48 - 8 * o) << np.uint64(8) | key & np.uint64(255)
            more, m = [np.zeros(0, np.uint64)], [n.astype(np.float64)]
            for (order, context), (byte, times) in cut.items():
                if order == o:
                    m[0][node >> np.uint64(8) == np.uint64(context)] = 0
                    more.append(np.uint64(context << 8) | byte.astype(np.uint64))
                    m.append(times.astype(np.float64))
            at, place = np.unique(np.concatenate([node, *more]), return_inverse=True)
            sums = np.r_[0, np.cumsum(np.bincount(place, np.concatenate(m), len(at)))]
            known = np.empty((9, len(at)), np.float32)
            for k in range(9):
                prefix = at >> np.uint64(8 - k)
                first = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]]) if len(at) else np.zeros(0, np.int64)
                size = np.diff(np.r_[first, len(at)])
                known[k] = np.repeat(sums[first + size] - sums[first], size)
            levels.append((place[:len(key)].astype(np.int32), known))
        return cls(keys=key, levels=levels)

    def last(self, key: np.ndarray) -> np.ndarray:
        """The last byte of context."""
        return (key >> np.uint64(40)).astype(np.int64)

    def inputs(self, key: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log-odds of the orders, gate, bit) of bit ``k``; ``own`` occurrences of the bit itself don't count."""
        at = np.searchsorted(self.keys, key)
        bit = (key >> np.uint64(7 - k) & np.uint64(1)).astype(np.int64)
        before = np.stack([known[k][place[at]] for place, known in self.levels])
        same = np.stack([known[k + 1][place[at]] for place, known in self.levels])
        other, same = before - same, same - np.float32(own)
        gate = (same + other > 0.5).sum(axis=0)
        return np.log((same + 0.4) / (other + 0.4)) * (2 * bit - 1), gate, bit


# The Spark side -------------------------------------------------------------------------------------

def _write_blocks(rows: DataFrame) -> DataFrame:
    """(block, docs, th, train, texts, n_bytes): the documents of each block, written to the shared folder."""
    def gather(batches):
        task, n_blocks = TaskContext.get().partitionId(), 0
        for b in sliced(batches):
            texts = [t or b"" for t in b.column(3).to_pylist()]
            for s in blocks(texts):
                part = b.slice(s.start, s.stop - s.start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << 24) + n_blocks]),
                     *(pa.array([part.column(i).to_pylist()], pa.list_(part.column(i).type)) for i in range(3)),
                     pa.array([texts[s]], pa.list_(pa.binary())), pa.array([sum(map(len, texts[s]))])],
                    names=["block", "docs", "th", "train", "texts", "n_bytes"])
                n_blocks += 1

    kind = rows.schema["doc_id"].dataType.simpleString()
    return write_once(rows.mapInArrow(
        gather, f"block long, docs array<{kind}>, th array<bigint>, train array<boolean>, texts array<binary>, "
                "n_bytes long"), "lm-blocks")


def _n_ranges(spark: SparkSession, n_bytes: int) -> int:
    """One for each SHARD_BYTES of text, and at least the session's number of shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / SHARD_BYTES))


def _range_edges(rows: DataFrame, n_bytes: int, n_docs: int, n_ranges: int) -> np.ndarray:
    """Ascending n-grams, by context, that cut what the blocks will send into ranges of about equal size.

    Taken from a sample of documents; which ones are taken changes the balance
    of the ranges alone.  The driver gets a million n-grams, or four for each
    range beyond (24 bytes for 8 MB of text).
    """
    n_keys = max(SAMPLE_KEYS, 4 * n_ranges)
    share = min(1.0, max(SAMPLE_BYTES / max(1, n_bytes), 1000 / max(1, n_docs), n_keys / max(1, n_bytes)))
    step = max(1, math.ceil(share * n_bytes / n_keys))

    def sample(batches):
        for b in sliced(batches):
            texts = [t or b"" for t in b.column(0).to_pylist()]
            for s in blocks(texts):
                key = np.unique(by_context(six_grams(texts[s])[0]))
                yield pa.RecordBatch.from_pydict({"a": [planes(key[len(key) % step::step])]})

    taken = F.pmod(F.xxhash64("doc_id", "th"), F.lit(1 << 20)) < int(share * (1 << 20))
    got = [unplaned(r.a) for r in rows.where(taken).select("text").mapInArrow(sample, "a binary").collect()]
    key = np.sort(np.concatenate(got)) if got else np.zeros(0, np.uint64)
    return np.unique(key[np.arange(1, n_ranges) * len(key) // n_ranges]) if len(key) else key


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, documents) of all words and of the end of each text."""
    per_doc = [words(t.lower()) for t in texts]
    h = np.concatenate([np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)) for w in per_doc]
                       + [np.full(len(texts), _END)])
    return h, np.r_[np.repeat(np.arange(len(texts)), [len(w) for w in per_doc]), np.arange(len(texts))]


def _widths(n_ranges: int) -> list[int]:
    """Ranges in a group at each step of the way, the last 1: as few steps as ``FAN`` allows, of about equal fan-out."""
    steps = 1
    while FAN ** steps < n_ranges:
        steps += 1
    fan = next(f for f in range(max(1, round(n_ranges ** (1 / steps)) - 1), FAN + 1) if f ** steps >= n_ranges)
    return [fan ** i for i in range(steps - 1, -1, -1)]


def _cuts(edges: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams and the word hashes that cut ranges into groups of ``width``."""
    n = len(edges) + 1
    word_edges = np.array([(i << 64) // n for i in range(width, n, width)], np.uint64)
    return edges[width - 1::width], word_edges


def _pieces(block: int, key, grams, h, counts, cuts, word_cuts, first: int) -> pa.RecordBatch:
    """(shard, block, a, b, c, d): n-grams, their counts, words and theirs, a row for each group that gets some."""
    g = [0, *np.searchsorted(key, cuts).tolist(), len(key)]
    w = [0, *np.searchsorted(h, word_cuts).tolist(), len(h)]
    here = [s for s in range(len(cuts) + 1) if g[s] < g[s + 1] or w[s] < w[s + 1]]
    return pa.RecordBatch.from_arrays(
        [pa.array([first + s for s in here], pa.int32()), pa.array([block] * len(here), pa.int64()),
         pa.array([planes(key[g[s]:g[s + 1]]) for s in here], pa.binary()),
         pa.array([small(grams[g[s]:g[s + 1]]) for s in here], pa.binary()),
         pa.array([h[w[s]:w[s + 1]].tobytes() for s in here], pa.binary()),
         pa.array([small(counts[w[s]:w[s + 1]]) for s in here], pa.binary())],
        names=["shard", "block", *"abcd"])


_SENT = "shard int, block long, a binary, b binary, c binary, d binary"


def _count_blocks(docs: DataFrame, edges: np.ndarray, width: int = 1) -> DataFrame:
    """(shard, block, a, b, c, d): distinct n-grams and words of a block in each group of ``width`` ranges, and
    how often training has them."""
    cuts, word_cuts = _cuts(edges, width)

    def count(batches):
        for b in batches:
            for i in range(b.num_rows):
                texts, train = b.column(1)[i].as_py(), np.array(b.column(2)[i].as_py(), bool)
                key, start = six_grams(texts)
                key, grams = summed(by_context(key), np.repeat(train, np.diff(np.r_[start, len(key)])).astype(np.int64))
                h, doc = _word_hashes(texts)
                h, counts = summed(h, train[doc].astype(np.int64))
                del texts, start, doc  # while the pieces are sent, these aren't held as well
                yield _pieces(b.column(0)[i].as_py(), key, grams, h, counts, cuts, word_cuts, 0)

    return docs.select("block", "texts", "train").mapInArrow(count, _SENT)


def _merged_pieces(table: pa.Table) -> tuple[pa.Table, tuple, tuple, list, list]:
    """The pieces by block, the merged n-grams and words with their counts, and where each piece's are among them."""
    table = table.sort_by("block")
    keys = [unplaned(x) for x in table.column("a").to_pylist()]
    distinct, n, place = merged(keys, [large(x) for x in table.column("b").to_pylist()])
    heard = [np.frombuffer(x, np.uint64) for x in table.column("c").to_pylist()]
    word, times, at = merged(heard, [large(x) for x in table.column("d").to_pylist()])
    cut, cut_w = np.cumsum([len(k) for k in keys])[:-1], np.cumsum([len(k) for k in heard])[:-1]
    return table, (distinct, n), (word, times), np.split(place, cut), np.split(at, cut_w)


def _stations(sent: DataFrame, parts: int) -> DataFrame:
    """A row per group of ranges and part of the blocks: what the part sent there, merged, and how to take it apart.

    ``block`` names the station for the steps after it; blocks, places and
    spots say where the n-grams and words of each sender are.
    """
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        shard, part = (k.as_py() for k in key)
        table, (distinct, n), (word, times), place, at = _merged_pieces(table.drop_columns("part"))
        return pa.table({
            "block": [shard * parts + part], "shard": pa.array([shard], pa.int32()), "a": [planes(distinct)],
            "b": [small(n)], "c": [word.tobytes()], "d": [small(times)], "blocks": [table.column("block").to_pylist()],
            "places": [[small(np.diff(p, prepend=0)) for p in place]],
            "spots": [[small(np.diff(p, prepend=0)) for p in at]]})

    part = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part")
    return sent.select("*", part).groupBy("shard", "part").applyInArrow(
        merge, "block long, shard int, a binary, b binary, c binary, d binary, blocks array<bigint>, "
               "places array<binary>, spots array<binary>")


def _send_on(stations: DataFrame, edges: np.ndarray, width: int, fan: int) -> DataFrame:
    """What stations hold, cut for the groups of ``width`` ranges within theirs."""
    cuts, word_cuts = _cuts(edges, width)

    def send(batches):
        for b in batches:
            for block, shard, a, n, c, d in zip(*(x.to_pylist() for x in b.columns)):
                mine = slice(shard * fan, shard * fan + fan - 1)
                yield _pieces(block, unplaned(a), large(n), np.frombuffer(c, np.uint64), large(d), cuts[mine],
                              word_cuts[mine], shard * fan)

    return stations.select("block", "shard", *"abcd").mapInArrow(send, _SENT)


def _hand_back(stations: DataFrame, judged: DataFrame) -> DataFrame:
    """(block, shard, costs, words) for the senders of each station, from what came back to it."""
    def apart(station: pa.Table, costs: pa.Table) -> pa.Table:
        row, costs = station.to_pylist()[0], costs.sort_by("shard")
        cost = np.concatenate([np.frombuffer(c, "<f4") for c in costs.column("costs").to_pylist()])
        times = np.concatenate([large(w) for w in costs.column("words").to_pylist()])
        return pa.table([
            pa.array(row["blocks"], pa.int64()), pa.array([row["shard"]] * len(row["blocks"]), pa.int32()),
            pa.array([cost[np.cumsum(large(p))].tobytes() for p in row["places"]], pa.binary()),
            pa.array([small(times[np.cumsum(large(p))]) for p in row["spots"]], pa.binary())],
            names=["block", "shard", "costs", "words"])

    return stations.select("block", "shard", "blocks", "places", "spots").groupBy("block") \
        .cogroup(judged.groupBy("block")).applyInArrow(apart, _JUDGED)


def _merge_shards(sent: DataFrame) -> DataFrame:
    """A row per range: its n-grams (a) and training counts (b), and where the n-grams of each block are among them.

    blocks, places and words (the training counts of a block's words) go
    together; n_train and n_words are the words' totals.
    """
    def merge(table: pa.Table) -> pa.Table:
        table, (distinct, n), (_, times), place, at = _merged_pieces(table)
        return pa.table({
            "shard": table.column("shard")[:1], "a": [planes(distinct)], "b": [small(n)],
            "blocks": [table.column("block").to_pylist()],
            "places": [[small(np.diff(p, prepend=0)) for p in place]],
            "words": [[small(times[p]) for p in at]],
            "n_train": [int(times.sum())], "n_words": [int((times > 0).sum())]})

    return sent.groupBy("shard").applyInArrow(
        merge, "shard int, a binary, b binary, blocks array<bigint>, places array<binary>, words array<binary>, "
               "n_train long, n_words long")


def _cut_counts(grams: DataFrame, edges: np.ndarray) -> DataFrame:
    """(shard, cut): byte counts, over all ranges, of the contexts that the edges of a range lie in.

    Summed by Spark, packed by context (256 bytes at most) and joined to the
    ranges that need them: two edges and six orders for each.  The contexts of
    orders 0 and 1, 257 at most, which many ranges share, are broadcast.
    """
    def send(batches):
        for b in batches:
            for shard, a, n in zip(*(c.to_pylist() for c in b.columns)):
                key, n = unplaned(a), large(n)
                for o, context in _cut_contexts(edges, shard):
                    here = key >> np.uint64(48 - 8 * o) == np.uint64(context)
                    byte = np.bincount((key[here] & np.uint64(255)).astype(np.int64), n[here], 256).astype(np.int64)
                    at = np.flatnonzero(byte)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), o)), pa.array(np.full(len(at), context)), pa.array(at),
                         pa.array(byte[at])], names=["o", "context", "byte", "n"])

    def ask(batches):
        for b in batches:
            rows = [(s, *c) for s in b.column(0).to_pylist() for c in _cut_contexts(edges, s)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                              *(pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2))],
                                             names=["shard", "o", "context"])

    packed = grams.mapInArrow(send, "o long, context long, byte long, n long") \
        .groupBy("o", "context", "byte").agg(F.sum("n").alias("n")) \
        .groupBy("o", "context").agg(F.collect_list("byte").alias("byte"), F.collect_list("n").alias("n"))
    packed = write_once(packed, "lm-cut-contexts")
    asked = grams.select("shard").mapInArrow(ask, "shard int, o long, context long")
    got = asked.where("o < 2").join(F.broadcast(packed.where("o < 2")), ["o", "context"], "left") \
        .unionByName(asked.where("o >= 2").join(packed.where("o >= 2"), ["o", "context"], "left"))
    return write_once(got.groupBy("shard").agg(F.collect_list(F.struct("o", "context", "byte", "n")).alias("cut")),
                      "lm-cuts")


def _cut_contexts(edges: np.ndarray, shard: int) -> list[tuple[int, int]]:
    """(order, context) of the contexts that the edges of a range lie in."""
    mine = [int(e) for e in edges[max(0, shard - 1):shard + 1]]
    return sorted({(o, e >> 48 - 8 * o) for e in mine for o in range(ORDERS)})


def _totals(rows: DataFrame) -> np.ndarray:
    """Sums of the number ``x`` by cell, in whole 2^-20ths so that the order of rows doesn't matter."""
    got = rows.groupBy("cell").agg(F.sum(F.round(F.col("x") * (1 << 20)).cast("long")).alias("x")).collect()
    out = np.zeros(max((r.cell for r in got), default=-1) + 1)
    for r in got:
        out[r.cell] = r.x / (1 << 20)
    return out


def _cells(x: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(x)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(x[at])], names=["cell", "x"])


def _counted(a: bytes, n: bytes, cut: list | None, trained: bool = True) -> tuple[RangeModel, np.ndarray, np.ndarray]:
    """The counts of a range, and its n-grams: those of training with how often they occur, or all."""
    key, n = unplaned(a), large(n)
    if trained:
        key, n = key[n > 0], n[n > 0]
    sums = {(c["o"], c["context"]): np.array([c["byte"] or [], c["n"] or []], np.int64) for c in cut or []}
    return RangeModel.of(key, n, sums), key, n


def fit(grams: DataFrame) -> Model:
    """Weights and refining table from the ranges' training n-grams (a, b, cut)."""
    model = Model()
    shape = model.weights.shape

    def weigh(batches):
        for b in batches:
            for a, n, cut in zip(*(c.to_pylist() for c in b.columns)):
                own, key, m = _counted(a, n, cut)
                if len(key):
                    own.learn(key, m)
                    yield _cells(np.r_[m.sum(), own.weights.ravel() * m.sum()])

    learned = _totals(grams.mapInArrow(weigh, "cell int, x double"))
    if len(learned):
        model.weights = np.pad(learned, (0, 1 + math.prod(shape) - len(learned)))[1:].reshape(shape) / learned[0]
    weights = model.weights

    def refine(batches):
        for b in batches:
            for a, n, cut in zip(*(c.to_pylist() for c in b.columns)):
                own, key, m = _counted(a, n, cut)
                own.weights = weights
                yield _cells(sum((own.apm_counts(*part) for part in _parts(key, m)),
                                 np.zeros((2, 256, APM_CELLS))).ravel())

    refined = _totals(grams.mapInArrow(refine, "cell int, x double"))
    refined = np.pad(refined, (0, 2 * 256 * APM_CELLS - len(refined))).reshape(2, 256, APM_CELLS)
    model.apm = (refined[0] + 16 * model.apm) / (refined[1] + 16)
    return model


def _parts(key: np.ndarray, n: np.ndarray):
    for i in range(0, len(key), 1 << 16):
        yield key[i:i + (1 << 16)], n[i:i + (1 << 16)]


_JUDGED = "block long, shard int, costs binary, words binary"


def _judged(shards: DataFrame, model: Model) -> DataFrame:
    """(block, shard, costs, words): log10 probabilities of a block's n-grams in a range, and its words' counts."""
    weights, apm = model.weights, model.apm

    def judge(batches):
        for b in batches:
            for i in range(b.num_rows):
                shard, a, n, of, places, heard, cut = (c[i].as_py() for c in b.columns)
                own, key, _ = _counted(a, n, cut, trained=False)
                own.weights, own.apm = weights, apm
                cost = np.concatenate([own.log10(part) for part, _ in _parts(key, key)] or [np.zeros(0)]).astype("<f4")
                for j in range(0, len(of), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(of[j:j + 64], pa.int64()), pa.array([shard] * len(of[j:j + 64]), pa.int32()),
                         pa.array([cost[np.cumsum(large(p))].tobytes() for p in places[j:j + 64]], pa.binary()),
                         pa.array(heard[j:j + 64], pa.binary())], names=["block", "shard", "costs", "words"])

    return shards.select("shard", "a", "b", "blocks", "places", "words", "cut").mapInArrow(judge, _JUDGED)


def _document_rows(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, logs, score, n_bytes): a row per document, from its block's costs."""
    kind = docs.schema["docs"].dataType.elementType.simpleString()

    def gather(block: pa.Table, costs: pa.Table) -> pa.Table:
        row, costs = block.to_pylist()[0], costs.sort_by("shard")
        texts = row["texts"]
        cost = np.concatenate([np.frombuffer(c, "<f4") for c in costs.column("costs").to_pylist()]).astype(float)
        key, start = six_grams(texts)
        score = np.add.reduceat(cost[np.unique(by_context(key), return_inverse=True)[1]], start)
        h, doc = _word_hashes(texts)
        times = np.concatenate([large(w) for w in costs.column("words").to_pylist()])[
            np.unique(h, return_inverse=True)[1]]
        n = len(texts)
        return pa.table([pa.array(row["docs"], block.schema.field("docs").type.value_type),
                         pa.array([not t for t in row["train"]]), pa.array(np.bincount(doc, minlength=n)),
                         pa.array(np.bincount(doc, times > 0, n).astype(np.int64)),
                         pa.array(np.bincount(doc, np.log10(times + 1), n)), pa.array(score),
                         pa.array([len(t) + 1 for t in texts], pa.int64())],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "score", "n_bytes"])

    return docs.select("block", "docs", "train", "texts").groupBy("block").cogroup(judged.groupBy("block")) \
        .applyInArrow(gather, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, "
                              "score double, n_bytes long")


def score_documents(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base score and model score of every row, learned from the rows where ``train`` holds.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte).  A null text counts as empty: one token, its end.  A row
    where ``train`` is null is held out.  Without training rows every count is
    0 and the predictors know nothing: the base score is 0 for each token.
    Rows that repeat score alike; an empty table gives no rows, other columns
    aren't read.  Words are counted by 64-bit hashes, n-grams exactly.  A block
    holds whole texts of BLOCK_BYTES, or one longer text, whose bytes take some
    60 times their size in a worker.
    """
    spark = docs.sparkSession
    small_batches(spark)
    # a row here is a block or a range, so a batch of a thousand rows would be all that a task reads
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BLOCK_BYTES)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("th"),
                       F.coalesce(train, F.lit(False)).alias("train"), F.col(text).cast("binary").alias("text"))
    held = _write_blocks(rows)
    size = held.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("bytes"),
                    F.coalesce(F.sum(F.size("docs")), F.lit(0)).alias("n")).first()
    edges = _range_edges(rows, size.bytes, size.n, _n_ranges(spark, size.bytes))
    widths = _widths(len(edges) + 1)
    sent, stations, parts = _count_blocks(held, edges, widths[0]), [], max(1, held.count())
    for width, wider in zip(widths[1:], widths):
        parts = math.ceil(parts / (wider // width))
        stations.append(write_once(_stations(sent, parts), "lm-station"))
        sent = _send_on(stations[-1], edges, width, wider // width)
    shards = write_once(_merge_shards(sent), "lm-merged")
    n_train, n_words = shards.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    # a small table of cuts is broadcast by the planner, a large one is joined by sorting
    shards = shards.join(_cut_counts(shards.select("shard", "a", "b"), edges), "shard", "left")
    judged = _judged(shards, fit(shards.select("a", "b", "cut")))
    for station in reversed(stations):
        judged = _hand_back(station, judged)
    rows = _document_rows(held, judged)
    each = math.log10(n_train + n_words + 1)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
                       (F.col("logs") - F.col("n_tokens") * F.lit(each)).alias("base_score"), "score",
                       (-F.col("score") / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"))
