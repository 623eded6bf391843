"""Language identification by words first, then ever shorter character n-grams.

A word that training texts have, however rarely, counts by its log frequency in every language; an
unseen word counts by the mean log frequency of the longest of its n-grams that are known.  Texts
are tokenized once, into blocks of word numbers and counts.  Words meet once with their counts over
the corpus, and the answer waits for each block that has the word; no vocabulary and no table of
n-grams is sent whole to anyone, and none is cut.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import SideFiles, pieces, write_side_files, written

_WORD = re.compile(r"[^\W\d_]+")
_BLOCKS_OF_TASK = 1 << 20
#: What bounds a block, and so the memory of a task; word counts that are worked on at once.
_BLOCK_WORDS, _BLOCK_COUNTS = 500_000, 3_000_000
_STEP, _LISTED = 300_000, 20_000


@dataclass(frozen=True)
class LangConfig:
    """``longest``: characters of the longest n-grams; ``add``: what every count is raised by."""

    longest: int = 5
    add: float = 0.5


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORD.findall(text.lower()) if text else []


def grams_of(word: str, n: int) -> list[str]:
    """n-grams of the word between marks of its start and end."""
    marked = f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


def _grams(word: str, n: int) -> Column:
    """The same as a column expression."""
    marked = F.concat(F.lit("^"), word, F.lit("$")) if n > 1 else F.col(word)
    places = F.sequence(F.lit(1), F.length(marked) - (n - 1))
    return F.when(F.length(marked) >= n, F.transform(places, lambda i: F.substring(marked, i, n)))


# -- blocks ---------------------------------------------------------------------------------


def counted_blocks(rows: DataFrame, langs: list[str]) -> DataFrame:
    """``rows`` (id, learn, text, lang) as counts, a row for each block: ``(block, ids, learn,
    letters, sizes, words, counts, vocabulary, places, own, n)``: each text's distinct words
    (``sizes`` of them) by number with their counts, the block's words, and for training texts
    how often (``n``) a language (``own``) has a word (``places``)."""
    sent = rows.sparkSession.sparkContext.broadcast(langs)
    names = ["block", "ids", "learn", "letters", "sizes", "words", "counts", "vocabulary", "places", "own", "n"]

    def run(batches):
        lang_of = {x: i for i, x in enumerate(sent.value)}
        number = TaskContext.get().partitionId() * _BLOCKS_OF_TASK
        own: dict[str, int] = {}
        held, size = [], 0

        def row():
            ids, learned = (pa.concat_arrays([h[i] for h in held]) for i in (0, 1))
            letters, sizes, words, counts, langs_ = (np.concatenate([h[i] for h in held]) for i in range(2, 7))
            of_row = np.repeat(langs_, sizes)
            used = of_row >= 0
            codes, at = np.unique(words[used].astype(np.int64) * max(1, len(lang_of)) + of_row[used], return_inverse=True)
            n = np.bincount(at, counts[used], len(codes)).astype(np.int32)
            places, of = codes // max(1, len(lang_of)), codes % max(1, len(lang_of))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, learned, pa.array(letters))]
            binaries = [pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (sizes, words, counts)]
            vocabulary = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), pa.array(list(own), pa.string()))
            more = [pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (places, of, n)]
            return pa.RecordBatch.from_arrays([pa.array([number]), *lists, *binaries, vocabulary, *more], names)

        for batch in pieces(batches):
            if len(own) > _BLOCK_WORDS or size > _BLOCK_COUNTS:
                yield row()
                own, held, size, number = {}, [], 0, number + 1
            take = own.setdefault
            bags = [Counter(words_of(t)) for t in batch.column(2).to_pylist()]
            letters = np.array([any(w.isalpha() or any(map(str.isalpha, w)) for w in bag) for bag in bags], bool)
            words = np.array([take(w, len(own)) for bag in bags for w in bag], np.int32)
            counts = np.array([n for bag in bags for n in bag.values()], np.int32)
            learned, lang = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            langs_ = np.array([lang_of.get(x, -1) if ok else -1 for ok, x in zip(learned, lang, strict=True)], np.int32)
            held.append((batch.column(0), batch.column(1), letters, np.array([len(b) for b in bags], np.int32), words, counts, langs_))
            size += len(words)
        if held:
            yield row()

    kind = rows.schema["id"].dataType.simpleString()
    binaries = ", ".join(f"{n} binary" for n in ("sizes", "words", "counts"))
    schema = f"block bigint, ids array<{kind}>, learn array<boolean>, letters array<boolean>, {binaries}, vocabulary array<string>, places binary, own binary, n binary"
    return written(rows.select("id", "learn", "text", "lang").mapInArrow(run, schema), "blocks")


def _numbers(column: pa.Array, row: int) -> np.ndarray:
    return np.frombuffer(column[row].as_buffer(), np.int32)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _lists(values: list[np.ndarray], sizes: np.ndarray, kinds: list) -> list[pa.Array]:
    bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return [pa.ListArray.from_arrays(bounds, pa.array(x.astype(k))) for x, k in zip(values, kinds, strict=True)]


# -- words ----------------------------------------------------------------------------------


def met_words(blocks: DataFrame, langs: int) -> DataFrame:
    """``(block, local, word, langs, counts, first)``: for each block its words with their counts
    in the languages that have them, over all training texts.  ``word`` itself is given once
    (``first``), and always where no training text has it.

    Words come sorted; a word has a row for each block that has it, and these are held together.
    """
    names = ["word", "block", "local", "langs", "counts"]

    def listed(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                words = batch.column(1)[row].values
                places, own, n = (_numbers(batch.column(i), row) for i in (2, 3, 4))
                sizes = np.bincount(places, minlength=len(words))
                ends = np.concatenate([[0], np.cumsum(sizes)])
                for i in range(0, len(words), _LISTED):
                    j = min(i + _LISTED, len(words))
                    here = slice(ends[i], ends[j])
                    lists = _lists([own[here], n[here]], sizes[i:j], [np.int32, np.int32])
                    block = pa.array(np.full(j - i, batch.column(0)[row].as_py(), np.int64))
                    yield pa.RecordBatch.from_arrays([words.slice(i, j - i), block, pa.array(np.arange(i, j, dtype=np.int32)), *lists], names)

    def summed(table: pa.Table) -> pa.RecordBatch:
        columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.combine_chunks().columns]
        words = columns[0]
        starts = np.flatnonzero(np.concatenate([[True], pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False)]))
        runs = np.diff(np.append(starts, len(words)))
        owner = np.repeat(np.repeat(np.arange(len(starts)), runs), np.diff(columns[3].offsets.to_numpy()))
        codes, at = np.unique(owner * langs + columns[3].flatten().to_numpy(), return_inverse=True)
        counts = np.bincount(at, columns[4].flatten().to_numpy(), len(codes))
        sizes = np.bincount(codes // max(1, langs), minlength=len(starts))
        begins = np.cumsum(sizes) - sizes
        of_row = np.repeat(np.arange(len(starts)), runs)
        some = _ranges(begins[of_row], sizes[of_row])
        first = np.zeros(len(words), bool)
        first[starts] = True
        shown = words.take(pa.array(np.arange(len(words)), mask=~(first | (sizes[of_row] == 0))))
        lists = _lists([codes[some] % max(1, langs), counts[some]], sizes[of_row], [np.int32, np.int64])
        return pa.RecordBatch.from_arrays([columns[1], columns[2], shown, *lists, pa.array(first)], ["block", "local", "word", "langs", "counts", "first"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not len(table):
                continue
            words = table.column(0)
            last = len(words) - int(pc.sum(pc.equal(words, words[-1])).as_py())  # where the last word's rows begin
            if last:
                yield summed(table.slice(0, last))
            held = table.slice(last)
        if held is not None:
            yield summed(held)

    rows = blocks.select("block", "vocabulary", "places", "own", "n").mapInArrow(listed, "word string, block bigint, local int, langs array<int>, counts array<int>")
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "word").sortWithinPartitions("word")
    return written(dealt.mapInArrow(run, "block bigint, local int, word string, langs array<int>, counts array<bigint>, first boolean"), "met")


def unseen_words(met: DataFrame, longest: int, add: float) -> tuple[DataFrame, dict[int, dict[int, tuple[int, int]]]]:
    """``(word, size, langs, raised)``: for each unseen word the length of its longest known n-grams,
    and by how much these raise each language's log frequency on average; and for each length used
    the total and the number of kinds of each language's n-grams.

    The longest n-grams are counted in all training words; of a shorter length, each is the
    beginning of a longer one or the end of a word, so it is counted from these.
    """
    known = met.filter("first AND size(langs) > 0").select("word", F.explode(F.arrays_zip("langs", "counts")).alias("c")).select("word", F.col("c.langs").alias("lang"), F.col("c.counts").alias("n"))
    left = written(met.filter("first AND size(langs) = 0").select("word"), "unseen")
    out, grams, totals = None, None, {}
    marked = F.concat(F.lit("^"), "word", F.lit("$"))
    for size in range(longest, 0, -1):
        if not left.limit(1).count():
            break
        if grams is None:
            found = known.select("lang", "n", F.explode(_grams("word", size)).alias("gram"))
        else:
            found = grams.select("lang", "n", F.substring("gram", 1, size).alias("gram"))
            ends = known.filter(F.length(marked) >= size).select("lang", "n", F.right(marked, F.lit(size)).alias("gram"))
            found = found.unionByName(ends) if size > 1 else found.filter("gram <> '^'")
        grams = found.groupBy("gram", "lang").agg(F.sum("n").alias("n"))
        grams = written(grams, "grams")
        totals[size] = {r["lang"]: (r["tokens"], r["kinds"]) for r in grams.groupBy("lang").agg(F.sum("n").alias("tokens"), F.count("*").alias("kinds")).collect()}  # a row for each language
        # one row for each n-gram with its languages; the first of these counts the n-gram itself
        of_gram = grams.groupBy("gram").agg(F.collect_list(F.struct("lang", "n")).alias("c"))
        own = left.select("word", F.explode(_grams("word", size)).alias("gram")).join(of_gram, "gram")
        rows = own.select("word", F.posexplode("c").alias("at", "c")).select("word", "at", "c.lang", F.log((F.col("c.n") + add) / add).alias("raised")).repartition("word")
        by_lang = rows.groupBy("word", "lang").agg(F.sum("raised").alias("sum"), F.count_if(F.col("at") == 0).alias("grams"))
        scored = by_lang.groupBy("word").agg(F.collect_list(F.struct("lang", "sum")).alias("c"), F.sum("grams").alias("grams"))  # a language each
        mean = F.transform("c.sum", lambda x: x / F.col("grams")).alias("raised")
        scored = written(scored.select("word", F.lit(size).alias("size"), F.col("c.lang").alias("langs"), mean), "scored")
        out = scored if out is None else out.unionByName(scored)
        left = written(left.join(scored, "word", "left_anti"), "unseen")
    return out, totals


class LangModel:
    """Small tables: languages, their shares, and what a count of 0 gives by length (0: words)."""

    def __init__(self, langs: list[str], shares: list[int], totals: dict[int, dict[int, tuple[int, int]]], config: LangConfig):
        self.langs, self.add = langs, config.add
        share = np.array(shares, float)
        self.prior = np.log(share / share.sum()) if len(langs) else share
        self.least = np.zeros((config.longest + 1, len(langs)))
        for size, of in totals.items():
            tokens = np.array([of.get(i, (0, 0))[0] for i in range(len(langs))], float)
            kinds = max((k for _, k in of.values()), default=0)
            self.least[size] = np.log(config.add) - np.log(tokens + config.add * (kinds + 1))


def score_blocks(blocks: DataFrame, model: LangModel, seen: SideFiles, unseen: SideFiles | None, id_col: str) -> DataFrame:
    """A row for each text: the sums of its words, language by language."""
    sent = blocks.sparkSession.sparkContext.broadcast(model)
    names = [id_col, "learn", "lang_pred", "score"]

    def run(batches):
        m = sent.value
        width = len(m.langs)
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.column(0)[row].as_py()
                ids, learned, letters = (batch.column(i)[row].values for i in (1, 2, 3))
                sizes, words, counts = (_numbers(batch.column(i), row) for i in (4, 5, 6))
                length, entries = np.full(int(words.max(initial=-1)) + 1, -1), []
                for side, kind in ((seen, None), (unseen, "size")):
                    found = side.read(block, ["local", "langs", "raised", *([kind] if kind else [])]) if side is not None else None
                    if found is None or not len(found):
                        continue
                    found = found.combine_chunks()
                    local, langs, raised = (found.column(i).chunk(0) for i in range(3))
                    at = local.to_numpy()
                    length[at] = found.column(3).to_numpy() if kind else 0
                    entries.append((np.repeat(at, np.diff(langs.offsets.to_numpy())), langs.flatten().to_numpy(), raised.flatten().to_numpy()))
                owner, lang, raised = (np.concatenate([e[i] for e in entries]) if entries else np.zeros(0, int) for i in range(3))
                order = np.argsort(owner, kind="stable")
                lang, raised = lang[order], raised[order]
                each = np.bincount(owner, minlength=len(length))
                begins = np.cumsum(each) - each
                total = np.tile(m.prior, (len(sizes), 1))
                text = np.repeat(np.arange(len(sizes)), sizes)
                for i in range(0, len(words), _STEP):
                    w, n, t = words[i : i + _STEP], counts[i : i + _STEP].astype(float), text[i : i + _STEP]
                    known = length[w] >= 0
                    base = np.bincount(t[known] * len(m.least) + length[w][known], n[known], len(sizes) * len(m.least)).reshape(len(sizes), -1)
                    total += base @ m.least
                    some = _ranges(begins[w], each[w])
                    if len(some):
                        total += np.bincount(np.repeat(t, each[w]) * width + lang[some], np.repeat(n, each[w]) * raised[some], len(sizes) * width).reshape(-1, width)
                sure = letters.to_numpy(zero_copy_only=False).astype(bool) & bool(width)
                best = total.argmax(axis=1) if width else np.zeros(len(sizes), int)
                score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1) if width else np.zeros(len(sizes))
                pred = [m.langs[b] if ok else "und" for b, ok in zip(best.tolist(), sure.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([ids, learned, pa.array(pred, pa.string()), pa.array(np.where(sure, score, 0.0))], names)

    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    rows = blocks.select("block", "ids", "learn", "letters", "sizes", "words", "counts")
    return rows.mapInArrow(run, f"`{id_col}` {kind}, learn boolean, lang_pred string, score double")


def identify_languages(
    docs: DataFrame, learn: Column, config: LangConfig | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``(id, learn, lang_pred, score)`` of every row.

    Learns from rows where ``learn`` is true and the language and text are known; every language
    that such a row names is one to choose from.  ``score`` is the posterior of the language
    given; of equally likely ones the first by name is given.  Whole texts count, however long.
    Null texts and texts without a letter are ``und`` with score 0, and so is every text if nothing
    was learned.  Repeated rows count as often as they occur; a null id is kept; other columns are
    not read; an empty table gives an empty result.
    """
    config = config or LangConfig()
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"), text.alias("text"), F.when(text.isNotNull(), F.col(lang_col).cast("string")).alias("lang")
    )
    shares = {r["lang"]: r["count"] for r in rows.filter("learn AND lang IS NOT NULL").groupBy("lang").count().collect()}  # a row for each language
    langs = sorted(shares)
    blocks = counted_blocks(rows, langs)
    met = met_words(blocks, len(langs))
    totals = met.filter("first").select(F.explode(F.arrays_zip("langs", "counts")).alias("c")).groupBy("c.langs").agg(F.sum("c.counts").alias("tokens"), F.count("*").alias("kinds"))
    of_words = {r["langs"]: (r["tokens"], r["kinds"]) for r in totals.collect()}  # a row for each language
    unseen, of_grams = unseen_words(met, config.longest, config.add)
    raised = F.transform("counts", lambda n: F.log((n + config.add) / config.add).cast("float"))
    seen = write_side_files(met.filter("size(langs) > 0").select("block", "local", "langs", raised.alias("raised")), "seen", ["local"])
    side = None
    if unseen is not None:
        asked = met.filter("size(langs) = 0").select("word", "block", "local").join(unseen, "word")
        side = write_side_files(asked.select("block", "local", "size", "langs", F.col("raised").cast("array<float>").alias("raised")), "unseen", ["local"])
    return score_blocks(blocks, LangModel(langs, [shares[x] for x in langs], {0: of_words} | of_grams, config), seen, side, id_col)
