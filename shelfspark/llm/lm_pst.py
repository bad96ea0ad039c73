"""Language-model scores from a probabilistic suffix tree over tokens.

Texts are lower-cased (A-Z) and cut into words; one end follows a text's last word
and stands as context before its first.  The symbols are the V training tokens and
one for any other token, as for the unigram base.  The tree's states are contexts of
up to ``depth`` tokens.  With n the training count of a context and n(w) that of
token w behind it, a token seen at least twice there has

    P(w | context) = (n(w) - discount) / n + escape * P(w | suffix)

and any other, unseen ones too, escape * P(w | suffix), where the suffix is the
context without its first token and escape = 1 - sum over those tokens of
(n(w) - discount) / n, so all probabilities of a state sum to one.  A context is
retained if its distribution diverges from its suffix's by ``gain`` bits on absolute
counts, with one occurrence of each token left out:

    sum (n(w) - 1) log2(P(w | context) / P(w | suffix)) + (n - sum (n(w) - 1)) log2(escape) >= gain

and its suffixes are retained with it: those that fail give all that follows them.
As the counts are absolute, the tree grows with the corpus.  The root, of N tokens of
which n1 occur once, has P(w) = (c - r) / N and P(other) = r V / N, with r = n1 / V
between 0.05 and 0.95.

The longest retained state of each position scores it.  As log P differs from state
to suffix by log escape and, for the tokens listed, one more term, a text's score is
the sum of one value per token and per gram (run of 2 to depth + 1 tokens) that it
holds; the tree is a table of these values by 64-bit key, never collected.  Tokens and
grams that are at least 1/``head`` of the training tokens (so at most ``head`` of each
length) are broadcast; all other keys, none of them frequent, meet the table in hash
buckets that grow in number with the text.  A gram travels with 48 bits of its key beside its bucket.

Rows are packed: one holds arrays of all that goes from a task to a bucket, and a bucket
counts, joins and tells its states on arrays.  The tree grows by one token of context
at a time (``grow``): two shuffles and a table each, whose shuffle files go once it is written.

What cannot matter does not travel.  A gram seen twice has a context and a suffix seen
twice, and only grams that the tree holds have a value; both are tested against a bit
map of leading bits of the keys (``marks``, at most 16 MB).  A false hit costs a row
and changes no result, as counts and values are joined by the keys themselves.

Defined results: null or empty text: one token, the end; rows with a null doc_id
are learnt from; nothing to learn from: base and score 0; repeated rows: one row
each; empty table: empty result; further columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import cut, text_bytes, text_chunks

DEPTH = 3
GAIN = 8.0
DISCOUNT = 0.75
HEAD = 1_000_000
MARK_BITS = 27
_LOW = np.int64((1 << 48) - 1)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
END_TOKEN = xxhash.xxh64_intdigest(b"\n")  # no word holds a line feed


def _mixed(values: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of eight bytes each, as ``xxhash64`` of a long column with that seed."""
    one, two, three, four, five = (np.uint64(p) for p in (  # primes of XXH64: fixed values
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turn(x: np.ndarray, bits: int) -> np.ndarray:
        return x << np.uint64(bits) | x >> np.uint64(64 - bits)

    h = seed + five + np.uint64(8) ^ turn(values * two, 31) * one
    h = turn(h, 27) * one + four
    h = (h ^ h >> np.uint64(33)) * two
    h = (h ^ h >> np.uint64(29)) * three
    return h ^ h >> np.uint64(32)


_SPREAD = _mixed(np.arange(64 << 8, dtype=np.uint64), np.full(1, 42, np.uint64))  # by place in the word and byte
_LOWERED = np.frombuffer(bytes(range(256)).translate(_LOWER), np.uint8)
_IN_WORD = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _tokens(column: pa.Array, step: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token, the end tokens included, as int64, and the texts' number of
    tokens.  A word's hash is the sum of a pseudo-random number for each byte at its
    place, taken for about ``step`` bytes of words at a time."""
    data, offsets = text_bytes(column)
    inside = _IN_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    n = np.diff(np.searchsorted(starts, offsets))
    words = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + step)))
        low, high = starts[at], starts[to] if to < len(starts) else len(data)
        of = np.flatnonzero(inside[low:high])
        begin = starts[at:to] - low
        heads = np.searchsorted(of, begin)
        place = of - np.repeat(begin, np.diff(np.append(heads, len(of))))
        code = place << 8 | _LOWERED[data[low:high][of]]
        far = code >= len(_SPREAD)
        value = _SPREAD[np.where(far, 0, code)]
        if far.any():
            value[far] = _mixed(code[far].astype(np.uint64), np.full(1, 42, np.uint64))
        words[at:to] = np.add.reduceat(value, heads)
        at = to
    keys = np.full(len(words) + len(n), np.uint64(END_TOKEN))
    keys[np.arange(len(words)) + np.repeat(np.arange(len(n)), n)] = words
    return keys.view(np.int64), n + 1


def _pair(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Key of a gram from those of its first and of its last tokens, as
    ``xxhash64(context, suffix)``."""
    seed = _mixed(context.view(np.uint64), np.full(1, 42, np.uint64))
    return _mixed(suffix.view(np.uint64), seed).view(np.int64)


def _grams(keys: np.ndarray, sizes: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(position of the last token, key, context, suffix) of the grams of 2 to
    depth + 1 tokens of texts that have ``sizes`` tokens, the start's end included."""
    texts = len(sizes)
    ends = np.cumsum(sizes)
    padded = np.empty(len(keys) + texts, np.int64)  # an end before each text
    own = np.arange(len(keys)) + np.repeat(np.arange(1, texts + 1), sizes)
    padded[own] = keys
    padded[ends - sizes + np.arange(texts)] = np.uint64(END_TOKEN).view(np.int64)
    left = np.ones(len(padded), np.int64)  # tokens of the text up to here
    left[ends[:-1] + np.arange(1, texts)] = 1 - (sizes[:-1] + 1)
    left = np.cumsum(left)
    place = np.full(len(padded), -1)
    place[own] = np.arange(len(keys))
    level = padded
    for order in range(2, depth + 2):
        context, suffix = level[:-1], level[1:]
        level = _pair(context, suffix)
        inside = left[order - 1:] >= order
        yield place[order - 1:][inside], level[inside], context[inside], suffix[inside]


def _counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and how often (or with what weight) each occurs."""
    if weights is None:
        values = np.sort(values)
    else:
        order = np.argsort(values)
        values, weights = values[order], weights[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)
    if weights is None:
        return values[first], np.diff(np.append(first, len(values)))
    return values[first], np.add.reduceat(weights, first) if len(first) else weights[:0]


def _tallied(keys: np.ndarray, context: np.ndarray, suffix: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct grams by context, with the sum of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    at = order[first]
    return keys[first], context[at], suffix[at], np.add.reduceat(n[order], first) if len(first) else n[:0]


class _Counter:
    """Pre-aggregates counts in bounded memory: what outgrows ``limit`` is handed
    out by ``add``, the rest by ``rest``."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.size, self.parts = limit, 0, []

    def _merged(self) -> tuple[np.ndarray, ...]:
        return _tallied(*(np.concatenate(x) for x in zip(*self.parts)))

    def add(self, keys: np.ndarray, context: np.ndarray, suffix: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        self.parts.append(_tallied(keys, context, suffix, np.ones(len(keys), np.int64)))
        self.size += len(self.parts[-1][0])
        if self.size <= self.limit:
            return []
        merged = self._merged()
        if len(merged[0]) <= self.limit // 2:
            self.parts, self.size = [merged], len(merged[0])
            return []
        self.parts, self.size = [], 0
        return [merged]

    def rest(self) -> list[tuple[np.ndarray, ...]]:
        return [self._merged()] if self.parts else []


def held_out(doc_id: Column | str = "doc_id", modulus: int = 7, rest: int = 2) -> Column:
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == rest, F.lit(False))


def marks(keys: DataFrame) -> np.ndarray:
    """Bit map of the leading bits of a table's keys (key long): eight bits or more a key
    where that is within 2 ** MARK_BITS, whatever comes beyond makes more false hits."""
    bits = _mark_bits(keys.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _map_words(batch.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - bits)).to_batches()

    return _bit_map(keys.select("key").mapInArrow(run, "word long, bits long"), bits)


def _mark_bits(keys: int) -> int:
    return min(MARK_BITS, max(12, (8 * keys).bit_length()))


def _map_words(marked: np.ndarray) -> pa.Table:
    """The words of a bit map that hold the bits numbered ``marked``."""
    at = np.sort(marked.astype(np.uint64))
    word = at >> np.uint64(6)
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.empty(0, np.int64)
    one = np.uint64(1) << (at & np.uint64(63))
    return pa.table({"word": word[first].view(np.int64), "bits": (np.bitwise_or.reduceat(one, first) if len(first) else one).view(np.int64)})


def _bit_map(words: DataFrame, bits: int) -> np.ndarray:
    words = words.toArrow()
    out = np.zeros(1 << bits - 6, np.uint64)
    np.bitwise_or.at(out, words.column("word").to_numpy(), words.column("bits").to_numpy().view(np.uint64))
    return out


def _marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.view(np.uint64) >> np.uint64(65 - (64 * len(marks)).bit_length())
    return (marks[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _pack(*arrays: np.ndarray) -> bytes:
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(blob, np.int64, len(types)).tolist(), 8 * len(types), []
    for size, kind in zip(sizes, types):
        out.append(np.frombuffer(blob, kind, size, at))
        at += out[-1].nbytes
    return out


def _small(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are mostly below 255: a byte each, and in full those that are not."""
    return np.minimum(values, 255).astype(np.uint8), values[values >= 255].astype(np.int64)


def _full(low: np.ndarray, more: np.ndarray) -> np.ndarray:
    values = low.astype(np.int64)
    values[low == 255] = more
    return values


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of keys: a bucket's keys are alone in their part of a bit map."""
    return ((keys.view(np.uint64) >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int32)


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ascending ``keys``, whether it is there) of each of ``wanted``."""
    at = np.searchsorted(keys, wanted)
    if not len(keys):
        return at, np.zeros(len(wanted), bool)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def _dealt(by: np.ndarray, buckets: int, kind: str, *columns: np.ndarray) -> Iterator[tuple[int, str, int, bytes]]:
    """Rows (bucket, kind, size, found) of ``columns``, dealt by the bucket of ``by``."""
    bucket = _bucket_of(by, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        mine = order[cuts[b]:cuts[b + 1]]
        yield int(b), kind, len(mine), _pack(*(x[mine] for x in columns))


PACKED = "bucket int, kind string, size long, found binary"
_COLUMNS = {"token": (np.int64, np.int64),  # key, count
            "gram": (np.int64, np.int64, float, float),  # key, count, probability in a retained state, value
            "first": (np.int64, np.int64, float),  # a state of one token: key, count, value
            "state": (np.int64, np.int64, float)}  # a state of more
_LISTED = np.int64, np.int64, np.int64, float  # context, key, count, probability behind the suffix


def _table(rows: list[tuple[int, str, int, bytes]]) -> pa.Table:
    bucket, kind, size, found = zip(*rows) if rows else ((),) * 4
    return pa.table({"bucket": pa.array(bucket, pa.int32()), "kind": pa.array(kind, pa.string()), "size": pa.array(size, pa.int64()),
                     "found": pa.array(found, pa.binary())})


def _gathered(table: pa.Table, *types, kind: str | None = None) -> list[np.ndarray]:
    """The arrays of a bucket's rows (of one ``kind``), each kind of array in one."""
    kinds = table.column("kind").to_pylist()
    parts = [_unpack(blob, *types) for k, blob in zip(kinds, table.column("found").to_pylist()) if kind in (None, k)]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, t) for t in types]


@contextmanager
def _tidy(df: DataFrame) -> Iterator[None]:
    """A job run within leaves no shuffle files behind: nothing reads them again."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)


def _written(df: DataFrame, name: str) -> DataFrame:
    with _tidy(df):
        return cut(df, name)


def _together(left: DataFrame, right: DataFrame, buckets: int, fn) -> DataFrame:
    """``fn`` of the rows of either side in each bucket, in as many partitions as buckets."""
    sides = [x.repartition(buckets, "bucket").groupBy("bucket") for x in (left, right)]
    return sides[0].cogroup(sides[1]).applyInArrow(fn, PACKED)


def statistics(train: DataFrame, buckets: int) -> DataFrame:
    """Counts of the training texts' tokens, a row (key, count) a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for batch in text_chunks(batches):
            keys, _ = _tokens(batch.column("text"))
            for k, _, _, n in counter.add(keys, keys, keys):
                yield from _table(list(_dealt(k, buckets, "token", k, n))).to_batches()
        for k, _, _, n in counter.rest():
            yield from _table(list(_dealt(k, buckets, "token", k, n))).to_batches()

    def add(parts: pa.Table) -> pa.Table:
        keys, n = _counted(*_gathered(parts, np.int64, np.int64))
        return _table(list(_dealt(keys, buckets, "token", keys, n)))

    return train.select("text").mapInArrow(run, PACKED).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(add, PACKED)


def _marks_of(packed: DataFrame, keys_of, buckets: int) -> np.ndarray:
    """Marks of the keys ``keys_of(kind, row)`` of rows, put together by bucket."""
    bits = _mark_bits(packed.agg(F.sum("size")).first()[0] or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [(keys_of(kind, blob).view(np.uint64) >> np.uint64(64 - bits)).astype(np.uint32).tobytes()
                     for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("found").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(blobs, pa.binary())], names=["bucket", "found"])

    def add(parts: pa.Table) -> pa.Table:
        return _map_words(np.concatenate([np.frombuffer(x, np.uint32) for x in parts.column("found").to_pylist()]))

    found = packed.mapInArrow(run, "bucket int, found binary").repartition(buckets, "bucket")
    with _tidy(packed):
        return _bit_map(found.groupBy("bucket").applyInArrow(add, "word long, bits long"), bits)


def _twice(kind: str, blob: bytes) -> np.ndarray:
    keys, n = _unpack(blob, *_COLUMNS[kind])[:2]
    return keys[n > 1]


def _valued(kind: str, blob: bytes) -> np.ndarray:
    keys, *_, value = _unpack(blob, *_COLUMNS[kind])
    return keys[value != 0]


def _frequent(counts: DataFrame, least: int) -> pa.Table:
    """(kind, key, n, p, value) of tokens, grams and states that occur ``least`` times: for a bounded number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("found").to_pylist()):
                keys, n, *more = _unpack(blob, *_COLUMNS[kind])
                hit = n >= least
                p = more[0] if kind == "gram" else np.full(len(keys), np.nan)
                value = more[-1] if more else np.zeros(len(keys))
                yield pa.RecordBatch.from_arrays([pa.array([kind] * int(hit.sum()), pa.string()), *(pa.array(x[hit]) for x in (keys, n, p, value))],
                                                 names=["kind", "key", "n", "p", "value"])

    return counts.mapInArrow(run, "kind string, key long, n long, p double, value double").toArrow()


def grow(train: DataFrame, counts: DataFrame, order: int, often: tuple[np.ndarray, np.ndarray], behind, gain: float, discount: float,
         buckets: int, last: bool) -> DataFrame:
    """The tree's states of ``order`` - 1 tokens and the grams of ``order`` tokens that occur
    twice, dealt by key.  ``counts`` holds the same one token shorter (tokens at first), ``often`` the keys and probabilities of its
    frequent rows, ``behind(kind, row)`` the keys and probabilities of a row.

    A gram meets its suffix's probability where it is counted: in the suffix's bucket,
    or anywhere if the suffix is frequent.  What occurs twice then meets its context's
    count in the context's bucket, where the state is told."""
    spark = train.sparkSession
    known, hot = spark.sparkContext.broadcast(_marks_of(counts.where("kind in ('token', 'gram')"), _twice, buckets)), spark.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()

        def rows(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            for keys, context, suffix, n in parts:
                by = np.where(_found(hot.value[0], suffix)[1], keys, suffix)
                at = np.argsort(context)  # grams of a context together: it travels once
                by, context, suffix, n = by[at], context[at], suffix[at], n[at]
                out = []
                for b, kind, size, blob in _dealt(by, buckets, "seen", context, suffix, n):
                    c, s, m = _unpack(blob, np.int64, np.int64, np.int64)
                    c, runs = _counted(c)
                    out.append((b, kind, size, _pack(c, *_small(runs), s, *_small(m))))
                yield from _table(out).to_batches()

        for batch in text_chunks(batches):
            keys, sizes = _tokens(batch.column("text"))
            for _, gram, context, suffix in list(_grams(keys, sizes, order - 1))[-1:]:
                good = _marked(known.value, context) & _marked(known.value, suffix)
                yield from rows(counter.add(gram[good], context[good], suffix[good]))
        yield from rows(counter.rest())

    def seen(left: pa.Table, right: pa.Table) -> pa.Table:
        """Grams that occur twice with their probability behind the suffix (NaN: that has no state)."""
        parts = []
        for blob in left.column("found").to_pylist():
            c, runs, long_runs, s, m, more = _unpack(blob, np.int64, np.uint8, np.int64, np.int64, np.uint8, np.int64)
            parts.append((np.repeat(c, _full(runs, long_runs)), s, _full(m, more)))
        if not parts:
            return _table([])
        context, suffix, n = (np.concatenate(x) for x in zip(*parts))
        del parts
        keys, context, suffix, n = _tallied(_pair(context, suffix), context, suffix, n)
        twice = n > 1
        keys, context, suffix, n = keys[twice], context[twice], suffix[twice], n[twice]
        p = np.full(len(keys), np.nan)
        of, probability = _gathered(right, np.int64, float)
        by = np.argsort(of)
        for of, probability in (hot.value, (of[by], probability[by])):
            at, hit = _found(of, suffix)
            p[hit] = probability[at[hit]]
        if last:  # these are nobody's context
            good = ~np.isnan(p)
            keys, context, n, p = keys[good], context[good], n[good], p[good]
        return _table(list(_dealt(context, buckets, "listed", context, keys, n, p)))

    def states(left: pa.Table, right: pa.Table) -> pa.Table:
        context, keys, n, p = _gathered(left, *_LISTED)
        if not len(keys):
            return _table([])
        order_of = np.argsort(context, kind="stable")
        context, keys, n, p = context[order_of], keys[order_of], n[order_of], p[order_of]
        first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
        runs = np.diff(np.append(first, len(context)))
        counted = [_unpack(blob, np.int64, np.uint8, np.int64) for blob in right.column("found").to_pylist()]
        of_keys, of_n = (np.concatenate(x) for x in zip(*((k, _full(*m)) for k, *m in counted)))
        by = np.argsort(of_keys)
        of = of_n[by][_found(of_keys[by], context[first])[0]].astype(float)  # a context occurs as often as its gram: all are there
        escape = 1 - np.add.reduceat(n - discount, first) / of
        again = np.add.reduceat(n - 1, first, dtype=np.int64)
        whole = np.repeat(escape, runs)
        own = (n - discount) / np.repeat(of, runs) + whole * p
        bits = np.add.reduceat((n - 1) * np.log2(own / p), first) + (of - again) * np.log2(escape)
        kept = bits >= gain  # NaN, where the suffix has no state: no
        mine = np.repeat(kept, runs)
        value = np.where(mine, np.log10(own / p / whole), 0)
        own[~mine] = np.nan
        if last:
            keys, n, own, value = keys[mine], n[mine], np.full(int(mine.sum()), np.nan), value[mine]
        out = list(_dealt(keys, buckets, "gram", keys, n, own, value))
        heads, escape = context[first][kept], np.log10(escape[kept])
        return _table(out + list(_dealt(heads, buckets, "first" if order == 2 else "state", heads, of[kept].astype(np.int64), escape)))

    def slim(rows_of):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for b, kind, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "found"))):
                    columns = rows_of(kind, blob)
                    rows += [(b, kind, len(columns[0]), _pack(*columns))] if len(columns[0]) else []
                yield from _table(rows).to_batches()
        return counts.where("kind in ('token', 'gram')").mapInArrow(each, PACKED)

    def probabilities(kind: str, blob: bytes) -> tuple[np.ndarray, ...]:
        keys, p = behind(kind, blob)
        good = ~np.isnan(p)
        return keys[good], p[good]

    def contexts(kind: str, blob: bytes) -> tuple[np.ndarray, ...]:
        keys, n = _unpack(blob, *_COLUMNS[kind])[:2]
        return keys[n > 1], *_small(n[n > 1])

    sent = train.select("text").mapInArrow(run, PACKED)
    return _together(_together(sent, slim(probabilities), buckets, seen), slim(contexts), buckets, states)


def score(docs: DataFrame, depth: int = DEPTH, gain: float = GAIN, discount: float = DISCOUNT, modulus: int = 7, rest: int = 2,
          head: int = HEAD) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    train = rows.where(~held_out("doc_id", modulus, rest)).select("text")
    # a bucket for 32 MB of text, so for a few million keys at most
    buckets = max(8, (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) >> 25)
    tokens = _written(statistics(train, buckets), "lm-tokens")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("found").to_pylist():
                _, n = _unpack(blob, np.int64, np.int64)
                yield pa.RecordBatch.from_pydict({"n": [int(n.sum())], "v": [len(n)], "once": [int((n == 1).sum())]})

    size = tokens.mapInArrow(totals, "n long, v long, once long").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "once"))).first()
    total, distinct = size["n"], size["v"]
    root = min(max(size["once"] / max(1, distinct), 0.05), 0.95)
    other = float(np.log10(root * distinct / total)) if total else 0.0

    def behind(kind: str, blob: bytes) -> tuple[np.ndarray, np.ndarray]:
        if kind == "token":
            keys, n = _unpack(blob, *_COLUMNS["token"])
            return keys[n > 1], (n[n > 1] - root) / total  # of grams seen twice
        keys, _, p, _ = _unpack(blob, *_COLUMNS["gram"])
        return keys, p

    least = max(1, -(-total // head))
    top = _frequent(tokens, least).sort_by("key")  # at most ``head`` rows
    head_keys, head_counts = top.column("key").to_numpy(), top.column("n").to_numpy()
    head_values = np.log10((head_counts - root) / total) if total else head_counts * 0.0
    levels, often, frequent = [tokens], (head_keys, (head_counts - root) / max(1, total)), []
    for order in range(2, depth + 2 if total else 2):
        levels.append(_written(grow(train, levels[-1], order, often, behind, gain, discount, buckets, order == depth + 1), f"lm-level{order}"))
        frequent.append(_frequent(levels[-1], least))  # at most ``head`` grams and ``head`` contexts
        grams = frequent[-1].filter(pc.equal(frequent[-1].column("kind"), "gram")).sort_by("key")
        often = grams.column("key").to_numpy(), grams.column("p").to_numpy()
    often_keys, often_values = [np.empty(0, np.int64)], [np.empty(0)]
    for found in frequent:
        first = pc.equal(found.column("kind"), "first")
        tokens_of, longer = found.filter(first), found.filter(pc.invert(first))
        head_values[np.searchsorted(head_keys, tokens_of.column("key").to_numpy())] += tokens_of.column("value").to_numpy()
        often_keys.append(longer.column("key").to_numpy())
        often_values.append(longer.column("value").to_numpy())
    often_keys, often_values = _counted(np.concatenate(often_keys), np.concatenate(often_values))
    head_values, often_values = (x.astype(np.float32) for x in (head_values, often_values))  # a key's value, all terms summed

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What is not broadcast: tokens with counts, grams and states with values."""
        for batch in batches:
            out = []
            for b, kind, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "found"))):
                keys, n, *more = _unpack(blob, *_COLUMNS[kind])
                good = n < least if kind == "token" else (n < least) & (more[-1] != 0)
                if good.any():
                    out.append((b, "gram" if kind == "state" else kind, int(good.sum()), _pack(keys[good], *((more[-1][good],) if more else _small(n[good])))))
            yield from _table(out).to_batches()

    tree = levels[0]
    for level in levels[1:]:
        tree = tree.union(level)
    tail = tree.mapInArrow(rare, PACKED)
    listed = _marks_of(tree.where("kind in ('gram', 'state')"), _valued, buckets)
    shared = rows.sparkSession.sparkContext.broadcast((head_keys, head_counts, head_values, often_keys, often_values, listed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        head_keys, head_counts, head_values, often_keys, often_values, listed = shared.value
        for batch in text_chunks(batches):
            n_docs = batch.num_rows
            ids = batch.column("doc_id").to_pylist()
            keys, sizes = _tokens(batch.column("text"))
            doc = np.repeat(np.arange(n_docs, dtype=np.int32), sizes)
            at, hit = _found(head_keys, keys)
            known = np.bincount(doc[hit], minlength=n_docs)
            base = np.bincount(doc[hit], np.log10(head_counts[at[hit]] + 1), n_docs)
            value = np.bincount(doc[hit], head_values[at[hit]], n_docs)
            rare_tokens, rare_grams = (keys[~hit], doc[~hit]), [(np.empty(0, np.int64), np.empty(0, np.int32))]
            for place, gram, _, _ in _grams(keys, sizes, depth) if total else ():
                good = _marked(listed, gram)
                gram, of = gram[good], doc[place[good]]
                at, hit = _found(often_keys, gram)
                value += np.bincount(of[hit], often_values[at[hit]], n_docs)
                rare_grams.append((gram[~hit], of[~hit]))
            found: dict[int, list] = {}  # by bucket: documents, number of keys of each and keys, of tokens and of grams
            for place, (mine_keys, of) in enumerate((rare_tokens, tuple(np.concatenate(x) for x in zip(*rare_grams)))):
                bucket = _bucket_of(mine_keys, buckets)
                order = np.lexsort((of, bucket)) if place else np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(cuts)):
                    mine = order[cuts[b]:cuts[b + 1]]
                    docs_of, n = _counted(of[mine])  # ascending, as the keys are
                    found.setdefault(int(b), [(), ()])[place] = *_small(np.diff(docs_of, prepend=0)), *_small(n), mine_keys[mine]
            none = np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
            used, kinds = [int(chunk % buckets)], ["whole"]
            blobs = [_pack(np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids]), sizes, known, base, value)]
            for b, (mine, longer) in found.items():
                *longer, k = longer or none
                used.append(b)
                kinds.append("keys")
                blobs.append(_pack(*(mine or none), *longer, k.astype(np.uint32), (k >> 32).astype(np.uint16)))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([chunk] * len(used)), pa.array(kinds), pa.array(blobs, pa.binary())],
                                             names=["bucket", "chunk", "kind", "found"])
            chunk += 1

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        """Keys meet their values: per chunk known tokens, base and score by document."""
        counted = [_unpack(blob, np.int64, np.uint8, np.int64) for kind, blob in zip(right.column("kind").to_pylist(), right.column("found").to_pylist())
                   if kind == "token"]
        keys = np.concatenate([np.empty(0, np.int64), *(k for k, *_ in counted)])
        counts = np.concatenate([np.empty(0, np.int64), *(_full(*n) for _, *n in counted)])
        by = np.argsort(keys)
        keys, counts = keys[by], counts[by]
        logs = np.log10((counts - root) / max(1, total))
        firsts, values = _gathered(right, np.int64, float, kind="first")
        logs[np.searchsorted(keys, firsts)] += values
        logs = logs.astype(np.float32)
        grams, values = _gathered(right, np.int64, float, kind="gram")
        low, values = _counted(grams & _LOW, values)
        values = values.astype(np.float32)
        out = []
        for kind, blob in zip(left.column("kind").to_pylist(), left.column("found").to_pylist()):
            if kind == "whole":
                out.append(blob)
                continue
            small = np.uint8, np.int64, np.uint8, np.int64
            parts = _unpack(blob, *small, np.int64, *small, np.uint32, np.uint16)
            docs_of, n = np.cumsum(_full(*parts[:2])), _full(*parts[2:4])
            at, hit = _found(keys, parts[4])
            count, value = np.zeros(len(hit), np.int64), np.full(len(hit), other)
            count[hit], value[hit] = counts[at[hit]], logs[at[hit]]
            docs_too, n_too = np.cumsum(_full(*parts[5:7])), _full(*parts[7:9])
            at, hit = _found(low, parts[10].astype(np.int64) << 32 | parts[9])
            more = np.zeros(len(hit))
            more[hit] = values[at[hit]]
            all_docs = np.union1d(docs_of, docs_too)
            own, too = np.repeat(np.searchsorted(all_docs, docs_of), n), np.repeat(np.searchsorted(all_docs, docs_too), n_too)
            size = len(all_docs)
            out.append(_pack(*_small(np.diff(all_docs, prepend=0)), np.bincount(own, value, size) + np.bincount(too, more, size),
                             *_small(np.bincount(own[count > 0], minlength=size)), np.bincount(own, np.log10(count + 1), size)))
        return pa.table({"chunk": left.column("chunk"), "kind": left.column("kind"), "found": pa.array(out, pa.binary())})

    def merge(parts: pa.Table) -> pa.Table:
        kinds, blobs = parts.column("kind").to_pylist(), parts.column("found").to_pylist()
        ids, known_id, sizes, known, base, value = (x.copy() for x in _unpack(
            blobs[kinds.index("whole")], np.int64, bool, np.int64, np.int64, float, float))
        for kind, blob in zip(kinds, blobs):
            if kind == "keys":
                docs_low, docs_more, scores, more_low, more, logs = _unpack(blob, np.uint8, np.int64, float, np.uint8, np.int64, float)
                docs_of = np.cumsum(_full(docs_low, docs_more))
                known[docs_of] += _full(more_low, more)
                base[docs_of] += logs
                value[docs_of] += scores
        return pa.table({"doc_id": pa.array(ids, mask=~known_id), "n_tokens": sizes, "n_known": known, "base": base, "score": value})

    sent = rows.mapInArrow(run, "bucket int, chunk long, kind string, found binary")
    # as many partitions as buckets: a task's share does not grow with the input
    sent, tail = sent.repartition(buckets, "bucket"), tail.repartition(buckets, "bucket")
    parts = sent.groupBy("bucket").cogroup(tail.groupBy("bucket")).applyInArrow(meet, "chunk long, kind string, found binary")
    each = parts.groupBy("chunk").applyInArrow(merge, "doc_id long, n_tokens long, n_known long, base double, score double")
    per_token = float(np.log10(total + distinct + 1))
    return each.select("doc_id", held_out("doc_id", modulus, rest).alias("held_out"), "n_tokens", "n_known",
                       F.lit(total).cast("long").alias("train_tokens"),
                       (F.col("base") - F.col("n_tokens") * F.lit(per_token)).alias("base_score"), "score")
