"""Spelling variants: words that differ by one character, found through pairs of numbered trie nodes.

1. Tasks count the words of their texts and pass on partial counts.
2. Words are cut by range into blocks in code-point order; each block numbers the
   nodes of its own trie in one sorted pass. Prefixes that reach over a block's
   border keep the number that they had: the driver hands on the path of a
   block's last word, a few numbers a block. The same is done for the words
   reversed, so every prefix and every suffix of a word has an integer.
3. A word gives the pair (prefix node, suffix node) of every position that it may
   skip, and of every gap where it may take another character. Two words share the
   pair of skipped positions just if they differ there by a replacement, and a
   word's gap equals another's skipped position just if the other has one
   character more. A character that repeats the one before it is skipped only as
   the first of its run, so that each neighbour is met once.
4. A pair has as many words as the alphabet has letters at most, so one window over
   it counts neighbours and finds the most frequent; no pairs of words are made.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tripforge.llm.textcore import chunks
from tripforge.work import bounded_batches, saved

#: Distinct words that a task counts before it passes them on.
HELD = 300_000
#: Words of a block whose trie one task numbers.
BLOCK = 100_000
#: Characters of words whose pairs are made at a time.
AT_ONCE = 200_000
#: The node of the empty prefix and of the empty suffix.
ROOT = -1
#: What a pair of nodes stands for: a later one of equal characters skipped, another position skipped, a gap.
REPEATED, SKIPPED, GAP = 0, 1, 2


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7, least_count: int = 2, damage: int | None = None) -> DataFrame:
    """(word, n) of the letter runs `[A-Za-z\\u00C0-\\u00FF]+` of whole texts, A-Z lower-cased, with `least_length` code points and `least_count` occurrences at least.

    With `damage`, a run loses one character where `damage` divides the crc32 h of
    `<id>:<run>`: that at h modulo its length. Null and empty texts have no words; a
    null id counts as the text `null`. Repeated rows count each time.
    """
    bounded_batches(docs.sparkSession)
    # shorter runs stay too short, as a run can only lose characters
    pattern = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")

    def out(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                found = pattern.findall(text.encode().lower().decode())
                if damage is None:
                    held.update(found)
                else:
                    start = zlib.crc32(f"{'null' if name is None else name}:".encode())
                    for word, n in Counter(found).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % damage == 0:
                            k = h % len(word)
                            word = word[:k] + word[k + 1 :]
                            if len(word) < least_length:
                                continue
                        held[word] += n
                if len(held) > HELD:
                    yield out(held)
                    held.clear()
        if held:
            yield out(held)

    counted = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def trie_nodes(words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Of sorted words: the node of every prefix, word by word; the words' offsets into them; the number of nodes. Nodes are numbered from 0 in order of their first word, so the first word has 0, 1, …"""
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.diff(at)
    common = np.zeros(len(words), np.int64)
    alive, depth = np.arange(1, len(words)), 0
    while len(alive):
        alive = alive[np.minimum(length[alive], length[alive - 1]) > depth]
        alive = alive[chars[at[alive] + depth] == chars[at[alive - 1] + depth]]
        depth += 1
        common[alive] = depth
    made = length - common
    base = np.cumsum(made) - made - common
    nodes = np.zeros(len(chars), np.int64)
    deep, depth = np.flatnonzero(length > 0), 0
    while len(deep):
        last = np.maximum.accumulate(np.where(common[deep] <= depth, np.arange(len(deep)), 0))
        nodes[at[deep] + depth] = base[deep][last] + depth
        depth += 1
        deep = deep[length[deep] > depth]
    return nodes, at, int(made.sum())


def _number_block(table: pa.Table) -> pa.Table:
    """A block's words in order with their trie's nodes, and a row (place -1) that tells the block's size, first and last word and last path."""
    names, words = table["name"].to_numpy(), table["word"].to_pylist()
    order = sorted(range(len(words)), key=words.__getitem__)
    words = [words[i] for i in order]
    nodes, at, count = trie_nodes(words)
    block = table["block"][0].as_py()
    lists = pa.ListArray.from_arrays(pa.array(np.append(at, at[-1] + at[-1] - at[-2]), pa.int32()), pa.array(np.concatenate([nodes, nodes[at[-2] :]])))
    return pa.table({
        "block": pa.array([block] * (len(words) + 1), pa.int32()),
        "place": pa.array([*range(len(words)), -1], pa.int64()),
        "name": pa.array([*names[order].tolist(), count], pa.int64()),
        "word": pa.array([*words, words[0]], pa.string()),
        "last": pa.array([None] * len(words) + [words[-1]], pa.string()),
        "nodes": lists,
    })


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def number_nodes(words: DataFrame) -> DataFrame:
    """(name, word, rank, nodes) of a table (name long, word) of distinct words that are not empty: rank from 0 in code-point order, and the trie node of each prefix, from the shortest to the whole word. No word gives no row."""
    blocks = max(1, -(-words.count() // BLOCK))
    cut = saved(words.select("name", "word").repartitionByRange(blocks, "word").withColumn("block", F.spark_partition_id()), "blocks")
    local = saved(cut.groupBy("block").applyInArrow(_number_block, "block int, place long, name long, word string, last string, nodes array<long>"), "tries")
    offsets: dict[int, tuple[int, int, np.ndarray]] = {}
    ranks = numbers = 0
    before, path = "", np.zeros(0, np.int64)
    sizes = {r.block: r.n for r in local.where("place >= 0").groupBy("block").agg(F.count("*").alias("n")).collect()}
    for r in local.where("place < 0").orderBy("block").collect():
        # what the first word shares with the last one of the block before has numbers already
        kept = path[: _common(before, r.word)]
        offsets[r.block] = (ranks, numbers, kept)
        own = np.array(r.nodes, np.int64)
        path = own + numbers
        shared = own < len(kept)
        path[shared] = kept[own[shared]]
        before, ranks, numbers = r.last, ranks + sizes[r.block], numbers + r.name
    told = words.sparkSession.sparkContext.broadcast(offsets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 5_000):
                part = batch.slice(k, 5_000)
                lists = part.column(4)
                at = np.asarray(lists.offsets)
                own = lists.flatten().to_numpy()
                nodes, rank = own.copy(), part.column(1).to_numpy().copy()
                blocks = part.column(0).to_numpy()
                for b in np.unique(blocks):
                    first, offset, kept = told.value[b]
                    mine = np.repeat(blocks == b, np.diff(at))
                    rank[blocks == b] += first
                    nodes[mine] += offset
                    shared = mine & (own < len(kept))
                    nodes[shared] = kept[own[shared]]
                yield pa.RecordBatch.from_arrays([part.column(2), part.column(3), pa.array(rank), pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.array(nodes))], ["name", "word", "rank", "nodes"])

    return local.where("place >= 0").select("block", "place", "name", "word", "nodes").mapInArrow(run, "name long, word string, rank long, nodes array<long>")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prefix, suffix, id, n, kind) of every position to skip and every gap of words (id, n, word, nodes, reversed nodes)."""
    for batch in batches:
        sizes = np.array([len(w) for w in batch.column(2).to_pylist()], np.int64)
        total = np.cumsum(sizes)
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + AT_ONCE, side="right")))
            part, length = batch.slice(i, j - i), sizes[i:j]
            i = j
            at = np.concatenate([[0], np.cumsum(length)])
            chars = np.frombuffer("".join(part.column(2).to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
            row = np.repeat(np.arange(len(length)), length)
            place = np.arange(at[-1]) - at[row]
            prefix = np.full(at[-1] + len(length), ROOT)  # of each word: the nodes of its prefixes of 0, 1, … characters
            suffix = prefix.copy()
            wide = at[:-1] + np.arange(len(length))
            prefix[wide[row] + place + 1] = part.column(3).flatten().to_numpy()
            suffix[wide[row] + place + 1] = part.column(4).flatten().to_numpy()
            repeated = np.zeros(at[-1], bool)
            repeated[1:] = (chars[1:] == chars[:-1]) & (place[1:] > 0)
            every = np.repeat(np.arange(len(length)), length + 1)
            gap = np.arange(len(every)) - wide[every]
            word = np.concatenate([row, every])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([prefix[wide[row] + place], prefix])),
                    pa.array(np.concatenate([suffix[wide[row] + length[row] - place - 1], suffix[wide[every] + length[every] - gap]])),
                    pa.array(part.column(0).to_numpy()[word]),
                    pa.array(part.column(1).to_numpy()[word]),
                    pa.array(np.concatenate([np.where(repeated, REPEATED, SKIPPED), np.full(len(every), GAP)]).astype(np.int8)),
                ],
                ["prefix", "suffix", "id", "n", "kind"],
            )


def spelling_variants(words: DataFrame, ratio: int = 10, max_rounds: int = 64) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct words.

    n_near counts the words that differ by exactly one inserted, deleted or replaced
    character; form is the most frequent of them (ties: the smallest in code-point
    order) if its n is `ratio` times the word's or more, else null; root is where
    forms lead from the word. Null and empty words are left out; `ratio` must be over
    1, so that forms cannot lead in circles. Other columns, whatever their names, are
    ignored; an empty table gives an empty table.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1")
    plain = saved(words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("name")).where("word <> '' and name is not null"), "words")
    # the count travels as the name of the first numbering, the rank as that of the second
    known = saved(number_nodes(plain).select(F.col("rank").alias("id"), "word", F.col("name").alias("n"), "nodes"), "prefixes")
    ends = number_nodes(known.select(F.col("id").alias("name"), F.reverse("word").alias("word"))).select(F.col("name").alias("of"), F.col("nodes").alias("ends"))
    pairs = known.join(ends, known.id == ends.of).select("id", "n", "word", "nodes", "ends").mapInArrow(_pairs, "prefix long, suffix long, id long, n long, kind byte")

    same = Window.partitionBy("prefix", "suffix")
    own = F.struct("n", (-F.col("id")).alias("less"))
    skipped, single, gap = F.col("kind") != GAP, F.col("kind") == SKIPPED, F.col("kind") == GAP
    met = pairs.select(
        "id", "n", "kind", F.count("*").over(same).alias("all"), F.count_if(skipped).over(same).alias("skips"), F.count_if(single).over(same).alias("singles"), F.count_if(gap).over(same).alias("gaps"),
        F.max(F.when(skipped, own)).over(same).alias("best_skip"), F.max(F.when(single, own)).over(same).alias("best_single"), F.max(F.when(gap, own)).over(same).alias("best_gap"),
    ).where("all > 1")
    near = F.when(gap, F.col("singles")).otherwise(F.col("skips") - 1 + F.when(single, F.col("gaps")).otherwise(0))
    best = F.when(gap, F.col("best_single")).otherwise(F.greatest("best_skip", F.when(single, F.col("best_gap"))))
    # a word that is the most frequent of its pair has no form there
    other = F.when(best["less"] != -F.col("id"), best)
    found = saved(met.select("id", near.alias("near"), other.alias("best")).groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best")), "near")

    counts = known.select("id", "word", "n")
    fits = found.where("best is not null").select(F.col("id").alias("of"), "best").join(counts, F.col("of") == F.col("id")).where(F.col("best.n") >= ratio * F.col("n"))
    forms = saved(fits.select(F.col("of").alias("at"), (-F.col("best.less")).alias("form"), F.col("best.n").alias("form_n")), "forms")
    roots = saved(forms.select("at", F.col("form").alias("root")), "roots")
    for _ in range(max_rounds):
        # each round doubles the way that a root has come
        on = roots.select(F.col("at").alias("from"), F.col("root").alias("far"))
        moved, told = roots.join(on, F.col("root") == F.col("from"), "left"), Observation()
        roots = saved(moved.observe(told, F.count("far").alias("moved")).select("at", F.coalesce("far", "root").alias("root")), "roots")
        if not told.get["moved"]:
            break
    else:
        raise RuntimeError(f"forms not followed to their ends after {max_rounds} rounds")
    text = lambda key, name: counts.select(F.col("id").alias(key), F.col("word").alias(name))
    named = forms.join(roots, "at").join(text("form", "form_word"), "form").join(text("root", "root_word"), "root").select("at", "form_word", "root_word", "form_n")
    out = counts.join(found.select(F.col("id").alias("of"), "n_near"), F.col("id") == F.col("of"), "left").join(named, F.col("id") == F.col("at"), "left")
    return out.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
