"""Language-model scores by a probabilistic suffix tree over the bytes of normalised texts."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, forget, map_arrow, release_shuffles, stored, text_or_empty

#: Longest context in bytes. With the next byte a window is at most 7 bytes and fits a long.
DEPTH = 6
#: Contexts of so many bytes are always in the tree; longer ones must pass the test.
TOP = 2
#: A context is kept if what it adds to the training likelihood (natural log) is at least this for each of its next symbols.
PENALTY = 0.5
#: What every next symbol of a context gives up to the shorter suffix.
DISCOUNT = 0.9
#: Windows whose probabilities every worker holds, at most: only a short cut, those of all others are joined.
SLOTS = 1 << 21
#: Odd factors whose products with a window scatter it over the tables of slots.
MIXERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
#: The others are joined in so many passes, each over its share of all windows, so that the disk holds the shuffle of one share.
PASSES = 4
#: Different windows that a counting task holds before it hands them on, and those scored together.
HELD, CHUNK = 2_000_000, 250_000
#: Windows looked up at a time, few enough to stay in a processor's own cache.
LOOK_UP = 1 << 16
#: Words whose counts every worker holds; the counts of others are joined.
FREQUENT = 200_000
#: Bytes of text whose windows are counted, and scored, at a time.
SLICE, SCORED = 2 << 20, 256 << 10
MEMORY_WORDS = 300_000
FOLDS, HELD_OUT = 7, 2
END = b"\n"


def tokens(text: str) -> list[bytes]:
    """Words (runs of anything but ASCII white space) with A-Z lowered; the end is not among them."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def spelled_words(texts: pa.Array) -> tuple[list[bytes], pa.ListArray]:
    """Every text as its words, each with a space behind it, and a line end; and the :func:`tokens` of every text with the end, as numbers of different words."""
    plain = pc.ascii_trim_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    words = pc.ascii_split_whitespace(pc.if_else(pc.equal(plain, ""), None, plain))
    bodies = pc.binary_join_element_wise(pc.binary_join(words, " "), END.decode(), " ", null_handling="skip")
    coded = words.flatten().cast(pa.binary()).dictionary_encode()
    ends = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
    codes = np.insert(coded.indices.to_numpy(), ends, len(coded.dictionary)).astype(np.int32)
    kinds = pa.concat_arrays([coded.dictionary, pa.array([END], pa.binary())])
    starts = pa.array(np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]).astype(np.int32))
    return bodies.cast(pa.binary()).to_pylist(), pa.ListArray.from_arrays(starts, pa.DictionaryArray.from_arrays(pa.array(codes), kinds))


def windows(words: list[list[bytes]], depth: int = DEPTH, size: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The :func:`text_windows` of texts given as their words."""
    yield from text_windows((b" ".join([*text, END]) for text in words), depth, size)


def text_windows(bodies: Iterable[bytes], depth: int = DEPTH, size: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(windows, text number) of every byte of the texts, in slices of about ``size`` bytes.

    A text is its words, each with a space behind it, and a line end; a line end stands before it too. A window holds the byte in
    its lowest place and the ``depth`` bytes before it above; places before the text are zero.
    """
    head = b"\0" * (depth - 1) + END
    parts: list[tuple[bytes, bytes, int]] = []
    held = 0
    for number, body in enumerate(bodies):
        front = head
        for at in range(0, len(body), size):  # a very long text goes on with its last bytes in front
            part = body[at : at + size]
            parts.append((front, part, number))
            held += depth + len(part)
            front = (front + part[-depth:])[-depth:]
            if held >= size:
                yield _packed(parts, depth)
                parts, held = [], 0
    if parts:
        yield _packed(parts, depth)


def _packed(parts: list[tuple[bytes, bytes, int]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    raw = b"".join([bytes(8), *chain.from_iterable((front, part) for front, part, _ in parts)])
    # The eight bytes up to every byte, read as one number at once; a window is the lowest of them.
    keys = np.ndarray(len(raw) - 8, dtype=">i8", buffer=raw, offset=1, strides=(1,)).astype(np.int64)
    keys &= _mask(depth)
    sizes = np.array([len(part) for _, part, _ in parts])
    ends = np.cumsum(sizes + depth)
    keys = np.concatenate([keys[end - size : end] for size, end in zip(sizes.tolist(), ends.tolist(), strict=True)])
    return keys, np.repeat(np.array([number for _, _, number in parts]), sizes)


def window_counts(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(``key``, ``n``): every window in the texts of ``rows``, with its occurrences in those where ``train`` holds."""

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for part in _slices(batch):
                for texts, times in ((part.filter(part.column("train")), 1), (part.filter(pc.invert(part.column("train"))), 0)):
                    for keys, _ in text_windows(spelled_words(texts.column("text"))[0], depth):
                        unique, n = np.unique(keys, return_counts=True)
                        held.append((unique, (n * times).astype(np.int32)))
                if sum(len(keys) for keys, _ in held) > 2 * HELD:
                    held = [_merged(held)]
                    if len(held[0][0]) > HELD:
                        yield from _counted(*held.pop())
        if held:
            yield from _counted(*_merged(held))

    counted = rows.select("text", "train").transform(map_arrow, count, "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(columns) for columns in zip(*held, strict=True))
    held.clear()
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], np.add.reduceat(n, heads, dtype=np.int64)


def _counted(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(keys), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 100_000]), pa.array(n[at : at + 100_000].astype(np.int64))], names=["key", "n"])


def word_counts(rows: DataFrame) -> DataFrame:
    """(``word``, ``n``): occurrences of every token in all texts of ``rows``; the end is the token of one line end."""

    def count(batches):
        held: list[pa.Table] = []
        for batch in batches:
            for part in _slices(batch):
                held.append(_sums(spelled_words(part.column("text"))[1].flatten().value_counts()))
                if sum(map(len, held)) > 2 * MEMORY_WORDS:
                    held = [_summed(held)]
                    if len(held[0]) > MEMORY_WORDS:
                        yield from held.pop().to_batches(50_000)
        if held:
            yield from _summed(held).to_batches(50_000)

    return rows.select("text").transform(map_arrow, count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _sums(counts: pa.StructArray) -> pa.Table:
    return pa.table({"word": counts.field("values").dictionary_decode(), "n": counts.field("counts")})


def _summed(held: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])


def _slices(batch: pa.RecordBatch, rows: int = 512):
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _mask(level: int) -> int:
    """Selects the window of a context of ``level`` bytes from a longer one."""
    return (1 << 8 * (level + 1)) - 1


def top_probabilities(counts: DataFrame, top: int) -> DataFrame:
    """(``short``, ``p``): smoothed probability of the last byte of every window after a context of ``top`` bytes.

    Shorter contexts weigh a symbol by the different bytes that stand in front of the window in training: a suffix speaks where the longer
    context is new, so what counts is after how many of them the symbol follows. Every byte can come next, seen or not.
    """
    levels = {top + 1: counts.groupBy(F.col("key").bitwiseAND(F.lit(_mask(top + 1))).alias("key")).agg(F.sum("n").alias("fronts"))}
    for k in range(top, -1, -1):
        shorter = levels[k + 1].groupBy(F.col("key").bitwiseAND(F.lit(_mask(k))).alias("key"))
        levels[k] = stored(shorter.agg(F.sum((F.col("fronts") > 0).cast("long")).alias("fronts")), f"suffix-level{k}")
    whole = levels[0].agg(F.sum("fronts")).first()[0] or 0
    above = levels[0].select(F.col("key").alias("short"), ((F.col("fronts") + 1) / F.lit(whole + 256.0)).alias("p"))
    for k in range(1, top + 1):
        context = F.shiftright("key", 8)
        totals = levels[k].groupBy(context.alias("context")).agg(F.sum("fronts").alias("weight"), F.sum((F.col("fronts") > 0).cast("long")).alias("kinds"))
        rows = levels[k].select("key", "fronts", context.alias("context"), F.col("key").bitwiseAND(F.lit(_mask(k - 1))).alias("short"))
        rows = rows.join(above, "short").join(totals, "context")
        p = F.greatest(F.col("fronts") - DISCOUNT, F.lit(0.0)) / F.col("weight") + DISCOUNT * F.col("kinds") / F.col("weight") * F.col("p")
        above = stored(rows.select(F.col("key").alias("short"), F.when(F.col("weight") > 0, p).otherwise(F.col("p")).alias("p")), f"suffix-top{k}")
    return above


def tree_scores(keys: np.ndarray, n: np.ndarray, base: np.ndarray, depth: int, top: int, penalty: float = PENALTY) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Natural log probability of the last byte of every window, and the contexts kept per length.

    ``keys`` are different windows with their ``n`` occurrences in training (0: none) and ``base``, the probability after ``top`` bytes. They hold every
    window of each context of ``top`` + 1 bytes that occurs in them, so nothing else bears on the result. A context is kept if the Kullback-Leibler
    divergence of its next symbols from those smoothed by its suffixes, times its occurrences and divided by its different next symbols, reaches
    ``penalty``, or if a longer context that ends with it is kept. The longest kept context scores.
    """
    window, times, fronts, to_shorter = {depth: keys}, {depth: n.astype(np.float64)}, {depth: n.astype(np.float64)}, {}
    first = np.arange(len(keys))
    for k in range(depth - 1, top, -1):
        window[k], to_shorter[k + 1] = np.unique(window[k + 1] & _mask(k), return_inverse=True)
        size = len(window[k])
        times[k] = np.bincount(to_shorter[k + 1], times[k + 1], size)
        fronts[k] = np.bincount(to_shorter[k + 1], times[k + 1] > 0, size)
        first = to_shorter[k + 1][first]
    above = np.empty(len(window[top + 1]))
    above[first] = base
    smooth, place, share, rest, contexts, passes = above, {}, {}, {}, {}, {}
    for k in range(top + 1, depth + 1):
        if k > top + 1:
            smooth = smooth[to_shorter[k]]
        contexts[k], place[k] = np.unique(window[k] >> 8, return_inverse=True)
        size = len(contexts[k])
        total, weight = np.bincount(place[k], times[k], size), np.bincount(place[k], fronts[k], size)
        kinds = np.bincount(place[k], times[k] > 0, size)
        taught = times[k] > 0
        gain = np.zeros(size)
        np.add.at(gain, place[k][taught], times[k][taught] * np.log(times[k][taught] / smooth[taught]))
        known = total > 0
        gain[known] = (gain[known] - total[known] * np.log(total[known])) / kinds[known]
        passes[k] = known & (gain >= penalty)
        safe = np.where(weight > 0, weight, 1.0)
        share[k] = np.maximum(fronts[k] - DISCOUNT, 0) / safe[place[k]]
        rest[k] = np.where(weight > 0, DISCOUNT * kinds / safe, 1.0)[place[k]]
        smooth = share[k] + rest[k] * smooth
    for k in range(depth - 1, top, -1):
        longer = contexts[k + 1][passes[k + 1]] & ((1 << 8 * k) - 1)
        passes[k][np.searchsorted(contexts[k], longer)] = True
    score = above
    for k in range(top + 1, depth + 1):
        if k > top + 1:
            score = score[to_shorter[k]]
        score = np.where(passes[k][place[k]], share[k] + rest[k] * score, score)
    return np.log(score), {k: contexts[k][passes[k]] for k in contexts}


def window_scores(rows: DataFrame, *, depth: int = DEPTH, penalty: float = PENALTY) -> DataFrame:
    """(``key``, ``n``, ``log_p``) of every window of all texts, under the tree of those where ``train`` holds; a stored table.

    All counts and tests run over all texts, and the test is the same at every size, so the tree grows with the corpus. Windows are dealt out by the last ``TOP`` + 1
    bytes of their contexts: all longer contexts and windows that bear on one of them are then in one task, which goes through them in order.
    """
    top = min(TOP, depth - 1)
    counts = stored(window_counts(rows, depth), "suffix-windows")
    release_shuffles(rows.sparkSession)
    ends = top_probabilities(counts, top)
    keyed = counts.withColumn("short", F.col("key").bitwiseAND(F.lit(_mask(top)))).join(ends, "short")
    keyed = keyed.select(F.shiftright("key", 8).bitwiseAND(F.lit(_mask(top))).alias("class"), "key", "n", "p")

    def scored(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < CHUNK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            kinds = table.column("class").to_numpy()
            cut = int(np.searchsorted(kinds, kinds[-1]))  # the last class may go on
            if cut:
                yield from _log_p(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            size = len(kinds) - cut
        if size:
            yield from _log_p(pa.Table.from_batches(held))

    def _log_p(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, n, p = (table.column(c).to_numpy() for c in ("key", "n", "p"))
        log_p, _ = tree_scores(keys, n, p, depth, top, penalty)
        for at in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 100_000]) for c in (keys, n, log_p)], names=["key", "n", "log_p"])

    dealt = keyed.repartition("class").sortWithinPartitions("class")
    out = stored(dealt.transform(map_arrow, scored, "key long, n long, log_p double"), "suffix-probabilities")
    forget(counts)
    release_shuffles(rows.sparkSession)
    return out


class Slots:
    """Probabilities of windows in tables of slots. Of the windows of one slot the most frequent one has it, the others go on to a table half as large
    under another hash, so that none is lost and nearly every look-up ends in the first table."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, log_p: np.ndarray, slots: int) -> None:
        self._tables: list[tuple[np.uint64, np.uint64, np.ndarray]] = []
        order = np.argsort(-n, kind="stable")
        keys, log_p = keys[order], log_p[order]
        bits = max(1, slots - 1).bit_length()
        while len(keys) or not self._tables:
            factor, shift = np.uint64(MIXERS[len(self._tables) % len(MIXERS)]), np.uint64(64 - bits)
            slot, first = np.unique(_slot(keys, factor, shift), return_index=True)
            pairs = np.full((1 << bits, 2), -1, dtype=np.int64)
            pairs[slot, 0], pairs[slot, 1] = keys[first], log_p[first].view(np.int64)
            self._tables.append((factor, shift, pairs.view(np.complex128)[:, 0]))  # window and value of a slot are read as one number
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, log_p = keys[rest], log_p[rest]
            bits = max(bits - 1, len(keys).bit_length(), 1)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, which are known); the value of an unknown window is 0."""
        out, known = np.empty(len(keys)), np.empty(len(keys), dtype=bool)
        for at in range(0, len(keys), LOOK_UP):
            part = slice(at, at + LOOK_UP)
            out[part], known[part] = self._in_table(0, keys[part])
        left = np.flatnonzero(~known)
        for number in range(1, len(self._tables)):
            values, hit = self._in_table(number, keys[left])
            out[left], known[left] = values, hit
            left = left[~hit]
        return out, known

    def _in_table(self, number: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        factor, shift, slots = self._tables[number]
        pairs = slots[_slot(keys, factor, shift)].view(np.int64).reshape(-1, 2)
        hit = pairs[:, 0] == keys
        return np.where(hit, pairs[:, 1].view(np.float64), 0.0), hit


def _slot(keys: np.ndarray, factor: np.uint64, shift: np.uint64) -> np.ndarray:
    return ((keys.view(np.uint64) * factor) >> shift).view(np.int64)


def frequency(column: str = "n") -> Column:
    """Steps of counts that grow by a sixteenth power of two; -1 if a count is 0."""
    return F.when(F.col(column) > 0, F.floor(F.log2(column) * 16).cast("int")).otherwise(F.lit(-1))


def least_frequency(counts: DataFrame, most: int) -> int:
    """The least step of :func:`frequency` that at most ``most`` rows of ``counts`` reach; 0 at least."""
    sizes = dict(counts.groupBy(frequency().alias("step")).agg(F.count(F.lit(1)).alias("size")).collect())
    rows = 0
    least = max([0, *(step + 1 for step in sizes)])
    for step in sorted((step for step in sizes if step >= 0), reverse=True):
        rows += sizes[step]
        if rows > most:
            return least
        least = step
    return 0


def looked_up(words: pa.ListArray | list[list[bytes]], counts: tuple[pa.Array, np.ndarray] | dict[bytes, int]) -> tuple[np.ndarray, pa.Array]:
    """The counts of all words in a row (0 where ``counts``, words and their numbers, has none), and of each text its words that are not in ``counts``, with
    how often it has them."""
    if isinstance(words, list):
        words = pa.array(words, pa.list_(pa.binary()))
    known, numbers = (pa.array(counts, pa.binary()), np.array([*counts.values()])) if isinstance(counts, dict) else counts
    coded = words.flatten()
    coded = coded if pa.types.is_dictionary(coded.type) else coded.dictionary_encode()
    kinds, codes = len(coded.dictionary), coded.indices.to_numpy()
    n = np.append(numbers, 0)[pc.index_in(coded.dictionary, value_set=known).fill_null(len(numbers)).to_numpy()][codes].astype(np.float64)
    new = np.flatnonzero(n == 0)
    owner = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy())
    pairs, times = np.unique(owner[new] * kinds + codes[new], return_counts=True)
    word = coded.dictionary.take(pa.array(pairs % max(kinds, 1)))
    ends = np.searchsorted(pairs, np.arange(len(words) + 1) * kinds).astype(np.int32)
    return n, pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([word, pa.array(times, pa.int64())], names=["word", "times"]))


def document_scores(df: DataFrame, *, depth: int = DEPTH) -> DataFrame:
    """Log probabilities of all texts under a model of those outside the held-out fold (crc32 of the id modulo 7 is 2).

    Columns: ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (tokens seen in training), ``train_tokens``,
    ``base_score`` (add-one unigrams over tokens, log10), ``score`` (the model's log10 probability of the tokens). Tokens are
    spelled by the suffix tree byte by byte, in contexts that run on across the words of the text. Probabilities of frequent windows are held by the workers,
    those of the others are joined from the table of all windows; both are the same numbers. A NULL text is an empty
    one: its end only. Nothing to learn from means uniform bytes and no known token. Repeated rows are scored one by one, an empty table stays empty; other columns are not read.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), text_or_empty().alias("text")
    )
    training = rows.where(~F.col("held_out"))
    scores = window_scores(rows.withColumn("train", ~F.col("held_out")), depth=depth)
    floor = least_frequency(scores, SLOTS)
    top = scores.where(frequency() >= floor).toArrow()
    held = spark.sparkContext.broadcast(Slots(*(top.column(c).to_numpy() for c in ("key", "n", "log_p")), SLOTS))
    del top
    rest = scores.where(frequency() < floor)
    counts = stored(word_counts(training), "unigrams")
    release_shuffles(spark)
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("N"), F.count(F.lit(1)).alias("V")).first()
    all_tokens, kinds = int(sums["N"]), int(sums["V"])
    common = least_frequency(counts, FREQUENT)
    frequent = counts.where(frequency() >= common).toArrow()
    known = spark.sparkContext.broadcast((frequent.column("word").combine_chunks(), frequent.column("n").to_numpy()))

    def score(batches):
        counts_of = known.value
        for batch in batches:
            for part in _slices(batch):
                bodies, words = spelled_words(part.column("text"))
                spelled, others, owners = np.zeros(len(bodies)), [], []
                for keys, owner in text_windows(bodies, depth, SCORED):
                    values, found = held.value.look_up(keys)
                    spelled += np.bincount(owner, values, len(bodies))
                    others.append(keys[~found])
                    owners.append(owner[~found])
                at = np.searchsorted(np.concatenate(owners), np.arange(len(bodies) + 1))
                others = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(np.concatenate(others)))
                n, rare = looked_up(words, counts_of)
                starts = words.offsets.to_numpy()
                sizes, starts = np.diff(starts), starts[:-1]
                seen = np.add.reduceat((n > 0).astype(np.int64), starts)
                logs = np.add.reduceat(np.log10(n + 1), starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(sizes, pa.int64()), pa.array(seen, pa.int64()),
                        pa.array(logs, pa.float64()), pa.array(spelled), others, rare,
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "seen", "logs", "spelled", "windows", "rare"],
                )

    schema = "row long, doc_id long, held_out boolean, n_tokens long, seen long, logs double, spelled double, windows array<long>, rare array<struct<word: binary, times: long>>"
    # Row numbers tell repeated rows apart; they are written down with the rows before they are used.
    scored = stored(rows.withColumn("row", F.monotonically_increasing_id()).transform(map_arrow, score, schema), "suffix-scores")
    pairs = scored.select("row", F.inline("rare"))
    others = pairs.join(counts.where(frequency() < common), "word").groupBy("row").agg(
        F.sum("times").alias("more_seen"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs")
    )
    # One join after the other, so that the disk holds the shuffles of one of them.
    others = stored(others, "suffix-words")
    release_shuffles(spark)
    parts = [stored(_spelled(scored, rest, part), f"suffix-spelled{part}") for part in range(PASSES)]
    spelled = reduce(DataFrame.unionByName, parts).groupBy("row").agg(F.sum("more_spelled").alias("more_spelled"))
    out = scored.drop("rare", "windows").join(others, "row", "left").join(spelled, "row", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("seen") + F.coalesce("more_seen", F.lit(0))).cast("long").alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(all_tokens + kinds + 1))).alias("base_score"),
        ((F.col("spelled") + F.coalesce("more_spelled", F.lit(0.0))) / F.lit(math.log(10))).alias("score"),
    )


def _spelled(scored: DataFrame, scores: DataFrame, part: int) -> DataFrame:
    """(``row``, ``more_spelled``) over one part of the windows that workers do not hold."""
    release_shuffles(scored.sparkSession)
    mine = F.pmod(F.xxhash64("key"), F.lit(PASSES)) == part
    keys = scored.select("row", F.explode("windows").alias("key")).where(mine)
    return keys.join(scores.select("key", "log_p").where(mine), "key").groupBy("row").agg(F.sum("log_p").alias("more_spelled"))
