"""Noise in text from scanned pages: broken words, misread signs, running lines, page numbers.

* Every page is read once, in Arrow batches. Boosted trees judge from its line pairs how far its lines end
  where the paper ended (``pages``); the judgements of a file's pages are added up. What flowing pages hold
  is counted as vocabulary, what printed pages hold beside it.
* Edits a scanner makes are learned from the corpus (``noise``): no list of misreadings is given.
* Furniture (read from the edge inward as long as lines repeat; where most of a page repeats it is shared
  text, of which the outermost line counts only): a boosted classifier of line pairs. Lines at the edges of pages, without case, numbers and
  punctuation, are paired with those that read alike on another page of the file (found by a group-by on
  learned spelling) and with the outermost line of the next two pages. Numbers alone on a line are furniture
  if number less place is met on another page. Reading goes on inward behind furniture, however deep.
* Broken words: a boosted classifier of line pairs looks at how often the joined word, the hyphenated
  compound and the two parts occur, and at the mark. The next page's first body line continues a page's
  last one.
* Misread words: words of printed pages that no flowing page holds get candidates by inverted joins on gapped
  q-grams (one place differs) and, for words left, on bigrams of the learned spelling; boosted trees rank
  all candidates. Wide signs have no words: windows of a sign and its neighbours are joined instead.

All classifiers are fitted at run time on the corpus itself, broken and misread as learned. Their samples
are bounded (``pages.SAMPLE_PAGES``, ``SAMPLE_WORDS``, ``SAMPLE_WINDOWS``), everything else covers all pages.

Defined results: null, empty and blank texts have no noise; repeated rows count once; a page that is
not in the page list belongs to no file and has no case; a kind of noise is reported once for each page.
Where no page flows, words met on three printed pages or more stand in as vocabulary; where no page is
printed there is no noise. A page read as flowing at odds over e^4 is read so in any file.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigraft.llm import pages
from lexigraft.llm.arrow import map_rows, record_batch
from lexigraft.llm.boosting import BoostedTrees
from lexigraft.llm.mapping import similar_pairs
from lexigraft.llm.noise import FEATURES, Noise, bigrams, gapped_pairs, learn_edits, weigh
from lexigraft.session import checkpointed, release, stored

SAMPLE_WORDS = 400
SAMPLE_WINDOWS = 1500
#: the most frequent known words are told apart before words move; they are known, so none is lost
COMMON = 20_000
FLOWING = -1.0
#: edge lines looked at in one round
ROUND = 3
_READ = "kind tinyint, sid string, score double, n int, lines array<string>, item string, a bigint, b bigint"
_ARROW = pa.schema([("kind", pa.int8()), ("sid", pa.string()), ("score", pa.float64()), ("n", pa.int32()), ("lines", pa.list_(pa.string())), ("item", pa.string()), ("a", pa.int64()), ("b", pa.int64())])
_LETTER = r"A-Za-z\x{aa}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}\x{370}-\x{3ff}\x{1e00}-\x{1fff}"


def _settle(spark: SparkSession) -> None:
    """Let the driver drop what a stage's fits have remembered and its plans have held."""
    bigrams.cache_clear()
    release(spark)


# -- reading -------------------------------------------------------------------------------------


def count_windows(texts: list[str], into: Counter) -> None:
    """Add every wide sign with both neighbours; texts and lines are kept apart."""
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype("int64")
    if len(codes) < 3:
        return
    a, m, b = codes[:-2], codes[1:-1], codes[2:]
    at = ((m >= 0x3400) & (m <= 0x9FFF) | (m >= 0x30A1) & (m <= 0x30FF)) & (a != 10) & (b != 10)
    keys, n = np.unique(a[at] << 42 | m[at] << 21 | b[at], return_counts=True)
    for k, x in zip(keys.tolist(), n.tolist()):
        into[chr(k >> 42) + chr(k >> 21 & 0x1FFFFF) + chr(k & 0x1FFFFF)] += x


def _whole_words(text: str) -> str:
    """The text without what may be part of a word at its beginning and end."""
    m = pages.WORD_AT.match(text)
    end = len(text)
    while end and (text[end - 1].isdigit() or pages.is_letter(text[end - 1])):
        end -= 1
    return text[m.end() if m else 0 : end]


class _Counts:
    """Words and windows of flowing and of printed pages, counted while a task reads."""

    def __init__(self) -> None:
        self.words, self.signs = (Counter(), Counter()), (Counter(), Counter())

    def add(self, ls: list[str], printed: bool) -> None:
        text = "\n".join(ls).lower()
        if printed:
            self.words[1].update({w for w in (t.rstrip("!|") for t in pages.TOKEN.findall(text)) if len(w) > 1})
        else:
            self.words[0].update(pages.COMPOUND.findall(_whole_words(text)))

    def add_signs(self, texts: list[list[str]], printed: bool) -> None:
        """Lines of a flowing page stand for themselves, a printed page runs on from line to line."""
        glue = "" if printed else "\n"
        some = [t for t in (glue.join(ls) for ls in texts) if not t.isascii()]
        for i in range(0, len(some), 1000):
            count_windows(some[i : i + 1000], self.signs[printed])

    def size(self) -> int:
        return sum(map(len, self.words + self.signs))

    def rows(self) -> Iterator[tuple]:
        for kind, (flow, printed) in ((1, self.words), (2, self.signs)):
            for x in flow.keys() | printed.keys():
                yield kind, None, None, None, None, x, flow.get(x, 0), printed.get(x, 0)


def _reader(model: BoostedTrees):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                sids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                raws = [pages.rows_of(t) for t in texts]
                feats = [pages.page_features(t, raw) for t, raw in zip(texts, raws)]
                at = [i for i, f in enumerate(feats) if f]
                scores = model.score(np.array([feats[i] for i in at], float).reshape(len(at), 8)).tolist()
                rows = []
                for i, score in zip(at, scores):
                    ls = [x for x in raws[i] if x]
                    counts.add(ls, score >= FLOWING)
                    rows.append((0, sids[i], score, len(ls), ls, None, None, None))
                for printed in (False, True):
                    counts.add_signs([r[4] for r in rows if (r[2] >= FLOWING) == printed], printed)
                yield record_batch((r if r[2] > -4 else (*r[:4], None, *r[5:]) for r in rows), _ARROW)
            if counts.size() > 500_000:  # partial counts: memory stays bounded
                yield record_batch(counts.rows(), _ARROW)
                counts = _Counts()
        yield record_batch(counts.rows(), _ARROW)

    return read


# -- furniture -----------------------------------------------------------------------------------

_NUMBER = re.compile(f"(?<![{pages.LETTER}])[0-9]+(?![{pages.LETTER}])|(?<![{pages.LETTER}0-9])[ivxlc]+(?![{pages.LETTER}0-9])")
_SIGN = re.compile(f"[^{pages.LETTER}0-9!|㐀-䶿一-鿿ァ-ヿ]+")


def normal_line(line: str) -> str:
    """A line without case, numbers, punctuation and blanks."""
    return _SIGN.sub("", _NUMBER.sub("", line.lower()))


def pair_features(a: str, b: str, noise: Noise) -> list[float]:
    """How two lines compare as two prints of one running line."""

    if a == b:
        return [1.0, 1.0, 1.0, math.log1p(len(a))]

    def jaccard(x: str, y: str) -> float:
        p, q = bigrams(x), bigrams(y)
        both = len(p & q)
        return both / (len(p) + len(q) - both)

    plain = jaccard(a, b)
    # lines with hardly a bigram in common are no closer in learned spelling
    return [plain, plain if plain < 0.15 else jaccard(noise.fold(a), noise.fold(b)), min(len(a), len(b)) / max(len(a), len(b), 1), math.log1p(min(len(a), len(b)))]


def _other(line: str, words: list[str], r: random.Random) -> str:
    """The line with one or two of its words (of wide text: some of its signs) replaced: another line that is much alike."""
    parts = line.split()
    if len(parts) > 2:
        for _ in range(r.randint(1, 2)):
            parts[r.randrange(len(parts))] = r.choice(words)
        return " ".join(parts)
    at = r.randrange(len(line))
    return line[:at] + r.choice(words) + line[at + r.randint(1, 4) :]


def fit_running(texts: list[str], noise: Noise) -> BoostedTrees:
    """Trees that tell two prints of a line, misread as learned, from two lines that are alike."""
    r = random.Random(len(texts))
    lines = sorted({x for t in texts for x in _some(pages.lines_of(t), r)})
    words = [w for x in lines for w in (x.split() if x.isascii() else [x[:3]])]
    x, y = [], []
    for raw, nxt in zip(lines, lines[1:]):
        a = normal_line(raw)
        pairs = [(noise.misread(a, r, r.randint(0, 3)), 1.0), (normal_line(nxt), 0.0), (normal_line(_other(raw, words, r)), 0.0), (normal_line(r.choice(lines)), 0.0)]
        for b, label in pairs:
            if a and b and not (label == 0 and noise.fold(a) == noise.fold(b)):
                x.append(pair_features(a, b, noise))
                y.append(label)
    return BoostedTrees(rounds=20).fit(np.array(x, float).reshape(len(x), 4), np.array(y, float))


def _some(lines: list[str], r: random.Random) -> list[str]:
    return r.sample(lines, min(3, len(lines)))


_EDGES = pa.schema([("sid", pa.string()), ("n", pa.int32()), ("edge", pa.int32()), ("depth", pa.int32()), ("no", pa.int32()), ("v", pa.int64()), ("key", pa.string()), ("line", pa.string())])


def _edge_rows(noise: Noise, lo: int, hi: int):
    """Lines ``lo``.. ``hi`` from both edges of each page: (sid, n, edge, depth, no, v, key, line)."""

    def rows(sids: list[str], pages_: list[list[str]]) -> Iterator[tuple]:
        for sid, ls in zip(sids, pages_):
            n = len(ls)
            for d in range(lo, min(hi, n)):
                for edge, no in ((0, d), (1, n - 1 - d)):
                    v = pages.page_value(ls[no])
                    line = normal_line(ls[no]) if v is None else ""
                    yield sid, n, edge, d, no, v, noise.fold(line) if len(line) > 1 else None, line

    return rows


def _running_udf(model: BoostedTrees, noise: Noise):
    @F.pandas_udf(T.DoubleType())
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        at = [i for i, (x, y) in enumerate(zip(a, b)) if x and y]
        out = np.full(len(a), -1.0)
        if at:
            out[at] = model.score(np.array([pair_features(a.iloc[i], b.iloc[i], noise) for i in at]))
        return pd.Series(out)

    return score


def furniture(lines: DataFrame, tasks: DataFrame, noise: Noise, model: BoostedTrees) -> DataFrame:
    """(sid, path, idx, no, kind): header and page-number lines. ``lines``: (sid, lines); ``tasks``: (sid, path, idx)."""
    score = _running_udf(model, noise)
    hi, part = ROUND, lines
    edges = None
    while True:
        new = map_rows(part, _edge_rows(noise, 0 if edges is None else hi // 2, hi), _EDGES).join(tasks, "sid")
        new = new.withColumn("kind", F.when(F.col("v").isNotNull(), "page_number").when(F.col("key").isNotNull(), "header"))
        new = new.withColumn("k", F.when(F.col("v").isNotNull(), F.col("v") - F.col("idx")).when(F.col("key").isNotNull(), F.xxhash64("key"))).drop("v", "key")
        edges = stored(new if edges is None else edges.unionByName(new))
        by = ["path", "edge", "kind", "k"]
        again = edges.where("kind is not null").groupBy(*by).agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"), F.min_by("line", "idx").alias("first"), F.max_by("line", "idx").alias("last")).where("lo < hi")
        met = edges.join(again, by, "left").withColumn("other", F.when(F.col("idx") == F.col("lo"), F.col("last")).otherwise(F.col("first")))
        sure = (F.col("kind") == "page_number") & F.col("lo").isNotNull()
        met = met.withColumn("hit", F.when(sure, True).when(F.col("other").isNull(), False).otherwise(score(F.when(F.col("other").isNotNull(), F.col("line")), "other") > 0))
        g = met.groupBy("sid", "path", "idx", "edge").agg(F.max("n").alias("n"), F.array_sort(F.collect_set(F.struct("depth", "no", "hit", "kind", "line"))).alias("a"))
        # what stands behind furniture only: the outermost line of body text is held against the next two pages'
        g = stored(g.withColumn("open", F.get(F.filter("a", lambda x: ~x["hit"]), F.lit(0))))
        o = g.where("open.kind = 'header'").select("path", "edge", "idx", "sid", F.col("open.depth").alias("depth"), F.col("open.no").alias("no"), F.col("open.line").alias("line"))
        nxt = o.select("path", "edge", F.explode(F.array(F.col("idx") - 1, F.col("idx") - 2)).alias("idx"), F.col("idx").alias("idx2"), F.col("sid").alias("sid2"), F.col("line").alias("line2"))
        near = o.join(nxt, ["path", "edge", "idx"]).where(F.least(F.length("line"), F.length("line2")) >= 0.5 * F.greatest(F.length("line"), F.length("line2")))
        near = near.where(score("line", "line2") > 0)
        extra = near.select("path", "edge", F.explode(F.array(F.struct("sid", "idx"), F.struct(F.col("sid2").alias("sid"), F.col("idx2").alias("idx")))).alias("s")).select("s.sid", "path", "s.idx", "edge").distinct().withColumn("more", F.lit(True))
        g = g.join(extra, ["sid", "path", "idx", "edge"], "left")
        take = F.aggregate("a", F.lit(0), lambda n, x: F.when((x["depth"] == n) & (x["hit"] | F.coalesce("more", F.lit(False)) & (x["depth"] == F.col("open.depth"))), n + 1).otherwise(n))
        g = stored(g.withColumn("take", take).where("take > 0").select("sid", "path", "idx", "n", "take", "a"))
        deep = g.where((F.col("take") >= hi) & (F.col("n") > hi)).select("sid").distinct()
        _settle(lines.sparkSession)
        if deep.isEmpty():
            # pages that share most of their lines share their text: no more than the outermost line is furniture
            g = g.withColumn("take", F.when((F.col("take") > ROUND) & (2 * F.col("take") > F.col("n")), 1).otherwise(F.col("take")))
            return g.select("sid", "path", "idx", F.inline(F.slice("a", F.lit(1), F.col("take")))).select("sid", "path", "idx", "no", "kind").distinct()
        part, hi = lines.join(deep, "sid", "left_semi"), 2 * hi


# -- body text -----------------------------------------------------------------------------------

_END = pa.struct([("no", pa.int32()), ("left", pa.string()), ("mark", pa.string()), ("right", pa.string()), ("over", pa.bool_())])
_BODY = pa.schema([("sid", pa.string()), ("path", pa.string()), ("idx", pa.int32()), ("n", pa.int32()), ("head", pa.string()), ("toks", pa.list_(pa.string())), ("parts", pa.list_(pa.string())), ("wins", pa.list_(pa.string())), ("ends", pa.list_(_END))])


def _body_rows(common, signs: frozenset):
    middle = re.compile("[" + re.escape("".join(sorted(signs))) + "]") if signs else None

    def rows(*columns: list) -> Iterator[tuple]:
        known = common.value
        for sid, path, idx, ls, gone in zip(*columns):
            drop = set(gone or ())
            body = [x for i, x in enumerate(ls) if i not in drop]
            if not body:
                continue
            text, joined = pages.unbroken(body)
            toks = [t.rstrip("!|") for t in pages.TOKEN.findall("\n".join(text).lower())]
            # a page may begin and end inside a word
            parts = {w for w in (*toks[:1], *toks[-1:], *(x.lower() for x in joined)) if len(w) > 1} - known
            toks = {w for w in toks[1:-1] if len(w) > 1} - known
            whole = "".join(body)
            wins = set() if middle is None or whole.isascii() else {whole[m.start() - 1 : m.start() + 2] for m in middle.finditer(whole) if 0 < m.start() < len(whole) - 1}
            ends = [dict(zip(("no", "left", "mark", "right", "over"), e)) for e in pages.broken_ends(body)]
            yield sid, path, idx, len(body), pages.head_of(body[0]), list(toks), list(parts), list(wins), ends

    return rows


def _score_udf(model: BoostedTrees, n: int):
    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for cols in batches:
            yield pd.Series(model.score(np.column_stack([c.to_numpy(float) for c in cols[:n]])))

    return score


# -- misread words -------------------------------------------------------------------------------


_RANKED = pa.schema([("w", pa.string()), ("c", pa.string()), ("a", pa.int64()), ("s", pa.float64()), ("learned", pa.bool_())])


def _rank(model: BoostedTrees, noise: Noise):
    def rows(w: list[str], c: list[str], a: list[int], b: list[int]) -> list[tuple]:
        x = np.array([noise.features(*k) for k in zip(w, c, a, b)], float).reshape(len(w), FEATURES)
        return [k for k in zip(w, c, a, model.score(x).tolist(), (x[:, 3] > 0).tolist()) if k[3] > 0]

    return rows


def misread_words(words: DataFrame, vocab: DataFrame, sound: DataFrame, noise: Noise) -> DataFrame:
    """(w, c, learned): misread words with their best correction, and whether all its edits are learned ones. ``words``, ``sound``: (w, n); ``vocab``: (w, a, b, n)."""
    spark = words.sparkSession
    r = random.Random(1)
    picked = [x.w for x in vocab.where("a >= 3").orderBy(F.xxhash64("w"), "w").limit(SAMPLE_WORDS).select("w").collect()]
    held = [x.w for x in sound.orderBy(F.xxhash64("w"), "w").limit(2 * SAMPLE_WORDS).collect()]
    made = {}
    letters = sorted({ch for w in picked for ch in w} | set("0123456789!|"))
    for w in picked:
        bad = noise.misread(w, r, 1 if r.random() < 0.8 else 2)
        if bad == w or r.random() < 0.25:  # edits not learned: any sign for any other, two in long words
            bad = w
            for _ in range(r.randint(1, 2) if len(w) > 7 else 1):
                i = r.randrange(len(bad))
                bad = bad[:i] + r.choice(letters) + bad[i + r.randint(1, 2) :]
        if bad != w and bad not in held:
            made[bad] = w
    rows = [(w, 1, made.get(w, "")) for w in sorted({*made, *held})]
    sample = spark.createDataFrame(rows, "w string, n bigint, truth string")
    real = words.select("w", F.col("n").cast("bigint").alias("n"), F.lit(None).cast("string").alias("truth"))
    # one place differs
    one = _ranked(_candidates(real.unionByName(sample), vocab, lambda d: gapped_pairs(d, vocab)), noise)
    _settle(spark)
    # more places differ: bigrams of the learned spelling
    fold = _fold_udf(noise)
    forms = vocab.select(F.col("w").alias("c"), fold("w").alias("form"))

    longest = vocab.agg(F.max(F.length("w")).alias("n")).first().n or 0

    def near(d: DataFrame) -> DataFrame:
        # a sign is misread as two signs at most
        v = d.where(F.length("w") <= 2 * longest).select("w").distinct().withColumn("value", fold("w"))
        p = similar_pairs(v.select("value").distinct(), forms.select("form").distinct(), 0.6)
        return v.join(p.drop("kind"), "value").join(forms, "form").where("w <> c").select("w", "c")

    two = _ranked(_candidates(real.join(one, "w", "left_anti").unionByName(sample), vocab, near), noise)
    _settle(spark)
    return one.unionByName(two)


def _candidates(words: DataFrame, vocab: DataFrame, pairs) -> DataFrame:
    """(w, c, a, b, truth) of candidates met more than twice as often as the word; ``truth`` is null for words that are no sample."""
    v = vocab.select(F.col("w").alias("c"), "a", "b", F.col("n").alias("m"))
    return stored(pairs(words).join(v, "c").join(words, "w").where("m > 2 * n").select("w", "c", "a", "b", "truth"))


def _ranked(cand: DataFrame, noise: Noise) -> DataFrame:
    """(w, c, learned): trees are fitted on the candidates of the sample and pick the best of all others."""
    t = cand.where("truth is not null").orderBy("w", "c", "truth").collect()
    x = np.array([noise.features(k.w, k.c, k.a, k.b) for k in t], float).reshape(len(t), FEATURES)
    model = BoostedTrees().fit(x, np.array([k.c == k.truth for k in t], float))
    good = map_rows(cand.where("truth is null").select("w", "c", "a", "b"), _rank(model, noise), _RANKED)
    return stored(good.groupBy("w").agg(F.max(F.struct("s", "a", "c", "learned")).alias("x")).select("w", "x.c", "x.learned"))


def looked_up(d: DataFrame, keys: dict[str, Column], counts: DataFrame) -> DataFrame:
    """``d`` with one column per key: its count in ``counts`` (t, n), 0 where there is none. One join for all keys."""
    d = d.withColumn("__i", F.xxhash64(*d.columns))
    rows = d.select("__i", F.explode(F.array(*[F.struct(F.lit(k).alias("q"), c.alias("t")) for k, c in keys.items()])).alias("x")).select("__i", "x.*")
    n = rows.join(counts, "t").groupBy("__i").agg(*[F.max(F.when(F.col("q") == k, F.col("n"))).alias(k) for k in keys])
    return d.join(n, "__i", "left").select(*[c for c in d.columns if c != "__i"], *[F.coalesce(k, F.lit(0)).alias(k) for k in keys])


def _fold_udf(noise: Noise):
    @F.pandas_udf(T.StringType())
    def fold(s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else noise.fold(x) for x in s], dtype=object)

    return fold


# -- wide signs ----------------------------------------------------------------------------------



def _sign(i: int) -> Column:
    return F.substring("win", i, 1)


_H = [f"h{i}" for i in range(1, 10)]


class Signs:
    """Counts of wide signs in flowing pages by what stands beside them."""

    def __init__(self, wins: DataFrame):
        """``wins``: (win, a, b)."""
        w = wins.select("win", "a", "b", _sign(1).alias("l"), _sign(2).alias("m"), _sign(3).alias("r"))
        self.all = w
        known = w.where("a > 0")
        self.three = known.select("l", "m", "r", F.col("a").alias("n"))
        star = F.lit("*")
        parts = F.explode(F.array(F.concat("l", "m", star), F.concat(star, "m", "r"), F.concat(star, "m", star)))
        sums = known.select(parts.alias("t"), "a").groupBy("t").agg(F.sum("a").alias("n"))
        # counts of windows, of signs with one neighbour, and of signs
        self.counts = stored(sums.unionByName(known.select(F.col("win").alias("t"), F.col("a").alias("n"))))

    def odd(self) -> DataFrame:
        """(win, l, m, r, own, u): windows of printed pages that no flowing page holds (u = 1) and those of
        flowing pages (u = 0), with a sign that stands beside one of its neighbours nowhere else."""
        w = self.all.where("a = 0 and b > 0").withColumn("u", F.lit(1)).unionByName(self.all.where("a > 0").withColumn("u", F.lit(0)))
        w = looked_up(w.select("win", "l", "m", "r", F.col("a").alias("own"), "u"), {"x": F.concat("l", "m", F.lit("*")), "y": F.concat(F.lit("*"), "m", "r")}, self.counts)
        return w.where("x <= own or y <= own")

    def edits(self) -> tuple[dict[tuple[str, str], tuple[float, float]], frozenset]:
        """Learned sign edits, and every sign that may be a misread one (no more than the script has)."""
        odd = stored(self.odd())
        p = odd.join(self.three.where("n > 2").select("l", "r", F.col("m").alias("put")), ["l", "r"]).where("put <> m")
        v = stored(p.groupBy(F.col("put").alias("meant"), F.col("m").alias("seen")).agg(F.sum("u").cast("double").alias("u"), F.sum(1 - F.col("u")).cast("double").alias("b")).where("u > 0"))
        rows = v.orderBy(F.desc("u"), "meant", "seen").limit(400).collect()
        size = {x.u: x["count"] for x in odd.groupBy("u").count().collect()}
        # a misread sign is met in more than one window, or in no flowing page at all
        alien = v.select(F.concat(F.lit("*"), "seen", F.lit("*")).alias("t"), "seen").join(self.counts, "t", "left_anti").select("seen")
        seen = v.where("u > 1").select("seen").union(alien).distinct().collect()
        return weigh(rows, size.get(1, 0), size.get(0, 0)), frozenset(x.seen for x in seen)

    def candidates(self, wins: DataFrame, edits: DataFrame) -> DataFrame:
        """(win, put, h1..h9, ...): signs that may be meant. ``wins``: (win, own, ...); ``edits``: (m, put, v, o)."""
        w = wins.select("*", _sign(1).alias("l"), _sign(2).alias("m"), _sign(3).alias("r"))
        by_place = w.join(self.three.select("l", "r", F.col("m").alias("put")), ["l", "r"]).where("put <> m")
        by_edit = w.join(F.broadcast(edits.where("v >= 1 and o > 0").select("m", "put")), "m")  # at most 400 edits
        out = by_place.unionByName(by_edit.select(by_place.columns)).distinct()
        star = F.lit("*")
        keys = {"a1": ("l", "m", star), "a2": (star, "m", "r"), "a3": (star, "m", star), "b0": ("l", "put", "r"), "b1": ("l", "put", star), "b2": (star, "put", "r"), "b3": (star, "put", star)}
        out = looked_up(out, {k: F.concat(*v) for k, v in keys.items()}, self.counts)
        out = out.join(F.broadcast(edits), ["m", "put"], "left")
        log = lambda c, less=F.lit(0): F.log1p(F.greatest(F.coalesce(c, F.lit(0)) - less, F.lit(0)))
        feats = [*(log(F.col(c), F.col("own")) for c in ("a1", "a2", "a3")), *(log(F.col(c)) for c in ("b0", "b1", "b2", "b3")), log(F.col("v")), F.coalesce("o", F.lit(-1.0))]
        return out.where("b0 > 0 or b1 > 0 or b2 > 0").select(*wins.columns, "put", *[f.cast("double").alias(h) for f, h in zip(feats, _H)])


def misread_windows(wins: DataFrame, signs: Signs, noise: Noise) -> DataFrame:
    """(win, put): windows whose middle sign is misread, with the sign that was meant. ``wins``: distinct (win)."""
    spark = wins.sparkSession
    edits = spark.createDataFrame([(y, x, float(n), float(o)) for (x, y), (n, o) in sorted(noise.signs.items())], "m string, put string, v double, o double")
    likely: dict[str, list[str]] = {}
    for (x, y), (n, o) in noise.signs.items():
        if n >= 1 and o > 0:
            likely.setdefault(x, []).append(y)
    good = signs.three.select(F.concat("l", "m", "r").alias("win"), F.col("n").alias("own"))
    may = good.where((F.col("own") > 2) & _sign(2).isin(*sorted(likely))) if likely else good.limit(0)
    sample = [x.win for x in may.orderBy(F.xxhash64("win"), "win").limit(SAMPLE_WINDOWS).collect()]
    bad = [(w[0] + y + w[2], 0, w[1]) for w in sample for y in likely[w[1]]]
    sound = [(x.win, x.own, "") for x in good.orderBy(F.xxhash64("win"), "win").limit(SAMPLE_WINDOWS).collect()]
    made = spark.createDataFrame(bad + sound, "win string, own bigint, meant string").distinct()
    new = wins.join(good, "win", "left_anti").select("win", F.lit(0).cast("bigint").alias("own"), F.lit(None).cast("string").alias("meant"))
    cand = stored(signs.candidates(made.join(good.select("win", F.col("own").alias("o2")), "win", "left").where("o2 is null or meant = ''").drop("o2").unionByName(new), edits))
    t = cand.where("meant is not null").select(*_H, (F.col("put") == F.col("meant")).cast("double").alias("y")).orderBy(*_H, "y").toPandas()
    model = BoostedTrees().fit(t[_H].to_numpy(float).reshape(len(t), 9), t["y"].to_numpy(float))
    scored = cand.where("meant is null").withColumn("s", _score_udf(model, 9)(*_H)).where("s > 0")
    return scored.groupBy("win").agg(F.max_by("put", F.struct("s", "put")).alias("put"))


# -- broken words --------------------------------------------------------------------------------

_Q = [f"q{i}" for i in range(1, 7)]


def _pair_features(pairs: DataFrame, vocab: DataFrame, noise: Noise) -> DataFrame:
    """(left, right, mark, q1..q6): counts of words that read like the joined word and like the compound, and of both parts; the mark."""
    fold = _fold_udf(noise)
    d = pairs.select("left", "right", "mark").distinct()
    d = d.withColumn("joined", fold(F.concat("left", "right"))).withColumn("compound", fold(F.concat_ws("-", "left", "right")))
    # spelt as learned, and as written
    alike = vocab.select(F.concat(F.lit("~"), fold("tok")).alias("t"), "n").unionByName(vocab.select(F.col("tok").alias("t"), "n")).groupBy("t").agg(F.sum("n").alias("n"))
    d = looked_up(d, {"q1": F.concat(F.lit("~"), "joined"), "q2": F.concat(F.lit("~"), "compound"), "q3": F.col("left"), "q4": F.col("right")}, alike)
    cnt = [F.log1p(q).alias(q) for q in _Q[:4]]
    soft = F.col("mark").isin("¬", "­").cast("double").alias("q5")
    return d.select("left", "right", "mark", *cnt, soft, (F.col("right") == "").cast("double").alias("q6"))


def broken_words(body: DataFrame, vocab: DataFrame, noise: Noise) -> DataFrame:
    """(sid, path, idx, no, left, right, over): words broken at the end of a line or (``over``) of a page."""
    spark = body.sparkSession
    ends = body.select("sid", "path", "idx", F.inline("ends")).distinct()
    # a page's last body line goes on at the first body line of the next page
    nxt = body.select("path", (F.col("idx") - 1).alias("idx"), "head").groupBy("path", "idx").agg(F.min("head").alias("head")).withColumn("over", F.lit(True))
    every = ends.join(nxt, ["path", "idx", "over"], "left").withColumn("right", F.when(F.col("over"), F.coalesce("head", F.lit(""))).otherwise(F.col("right"))).drop("head")
    every = stored(every)
    some = vocab.where((F.col("n") >= 2) & (F.length("tok") >= 5) & ~F.col("tok").contains("-")).orderBy(F.xxhash64("tok"), "tok").limit(SAMPLE_WORDS).select("tok")
    compounds = vocab.where(F.col("tok").contains("-")).orderBy(F.xxhash64("tok"), "tok").limit(SAMPLE_WORDS).select("tok")
    made = set()
    for k in some.unionByName(compounds).collect():
        r = random.Random(k.tok)
        if "-" in k.tok:
            a, b = k.tok.rsplit("-", 1)
            a = a.split("-")[-1]
            made |= {(a, b, "-", 0.0), (a, "", "-", 0.0)} if a and b else set()
        else:
            cut = r.randint(2, len(k.tok) - 2)
            made |= {(k.tok[:cut], k.tok[cut:], m, 1.0) for m in ("-", "­")} | {(k.tok[:cut], "", m, 1.0) for m in ("-", "¬")}
    made_df = spark.createDataFrame(sorted(made), "left string, right string, mark string, y double")
    feats = stored(_pair_features(every.select("left", "right", "mark").unionByName(made_df.select("left", "right", "mark")), vocab, noise))
    t = feats.join(made_df, ["left", "right", "mark"]).orderBy("left", "right", "mark", "y").toPandas()
    model = BoostedTrees().fit(t[_Q].to_numpy(float).reshape(len(t), 6), t["y"].to_numpy(float))
    _settle(spark)
    judged = feats.withColumn("s", _score_udf(model, 6)(*_Q)).where("s > 0").select("left", "right", "mark")
    return every.join(judged, ["left", "right", "mark"]).select("sid", "path", "idx", "no", "left", "right", "over").distinct()


# -- all together --------------------------------------------------------------------------------

_MARK_AT = re.compile("[-\u2010\u2011\u00ac\u00ad]$")


def repair_page(text: str, gone: set[int], broken: set[tuple[str, str]], words: dict[str, str], signs: dict[str, str], completes: str, first: str) -> str:
    """Paragraphs of one page: furniture left out, lines joined, broken words whole, misreadings corrected.

    ``completes``: what the next page holds of the page's last word; ``first``: what this page holds of the
    last word of the page before, which has it already.
    """
    paragraphs: list[str] = []
    open_ = fresh = False
    n = -1
    for line in text.replace("\r", "").split("\n"):
        line = line.strip(pages.BLANKS)
        if not line:
            open_ = False
            continue
        n += 1
        if n in gone:
            continue
        if first and not fresh and line.lower().startswith(first):
            line = line[len(first) :].lstrip()
        fresh = True
        if not open_ or not paragraphs:
            paragraphs.append(line)
        else:
            have = paragraphs[-1]
            marked = _MARK_AT.search(have)
            a, b = pages.WORD_AT.findall(have[:-1])[-1:] if marked else [], pages.WORD_AT.match(line)
            if marked and a and b and (a[0].lower(), b[0].lower()) in broken:
                paragraphs[-1] = have[:-1] + line
            elif marked and b:
                paragraphs[-1] = have + line
            else:
                wide = ord(have[-1]) > 0x2E80 or ord(line[0]) > 0x2E80
                paragraphs[-1] = have + ("" if wide else " ") + line
        open_ = True
    if completes and paragraphs and _MARK_AT.search(paragraphs[-1]):
        paragraphs[-1] = paragraphs[-1][:-1] + completes

    def put(m: re.Match) -> str:
        tail = len(m[0]) - len(m[0].rstrip("!|"))
        bare = m[0][: len(m[0]) - tail]
        new = words.get(bare.lower())
        if new is None:
            return m[0]
        return (new[:1].upper() + new[1:] if bare[:1].isupper() else new) + m[0][len(bare) :]

    out = "\n\n".join(p for p in paragraphs if p)
    if words:
        out = pages.WORD_AT.sub(put, out)
    for was, meant in signs.items():
        out = out.replace(was, meant)
    return out


@F.pandas_udf(T.StringType())
def _repaired(text: pd.Series, gone: pd.Series, broken: pd.Series, fixes: pd.Series, completes: pd.Series, first: pd.Series) -> pd.Series:
    some = lambda a: [] if a is None else a
    rows = []
    for t, g, b, f, c, d in zip(text, gone, broken, fixes, completes, first):
        pairs = [(x["was"], x["meant"]) for x in some(f)]
        han = {w: m for w, m in pairs if any(ord(ch) > 0x2E80 for ch in w)}
        rows.append(repair_page(t, set(some(g)), {(x["left"], x["right"]) for x in some(b)}, {w: m for w, m in pairs if w not in han}, han, c or "", d or ""))
    return pd.Series(rows, dtype=object)


class Scans:
    """The stages over one pair of tables; tables that several stages need are written once."""

    def __init__(self, sources: DataFrame, tasks: DataFrame, key: str = "source_id", text: str = "text", path: str = "relative_path", place: str = "chunk_index"):
        spark = sources.sparkSession
        self.sources, self.key, self.text = sources, key, text
        texts = sources.select(F.col(f"`{key}`").alias("sid"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null and sid is not null")
        self.tasks = tasks.select(F.col(f"`{key}`").alias("sid"), F.col(f"`{path}`").alias("path"), F.col(f"`{place}`").cast("int").alias("idx")).where("sid is not null and path is not null and idx is not null").distinct()
        sample = [r.text for r in texts.orderBy(F.xxhash64("sid"), "sid").limit(pages.SAMPLE_PAGES).collect()]
        read = stored(texts.mapInArrow(_reader(pages.fit_layout(sample)), _READ))
        page = read.where("kind = 0").select("sid", "score", "n", "lines")
        sums = lambda kind: read.where(F.col("kind") == kind).groupBy("item").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        words = sums(1).where(F.col("item").rlike(f"[{_LETTER}]")).select(F.regexp_replace("item", "[\u2010\u2011]", "-").alias("tok"), "a", "b")
        parts = F.when(F.col("tok").contains("-"), F.array_append(F.split("tok", "-"), F.col("tok"))).otherwise(F.array("tok"))
        words = words.select(F.explode(parts).alias("tok"), "a", "b").where("tok <> ''").groupBy("tok").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        self.words = stored(words.where(F.length("tok") > 1).withColumn("n", F.col("a") + F.col("b")))
        flows = self.words.where("a > 0").isEmpty()
        self.known = self.words.where("a > 0" if not flows else "b > 2").select("tok", F.col("b" if flows else "a").alias("n"))
        plain = self.words.where(~F.col("tok").contains("-")).withColumnRenamed("tok", "w")
        self.vocab = plain.where("n >= 3")
        self.sound = plain.where("a > 0").select("w", F.col("a").alias("n"))
        self.signs = Signs(stored(sums(2).withColumnRenamed("item", "win")))
        seen, middles = self.signs.edits()
        unknown = plain.where("a = 0 and b > 0").select("w", "n")
        self.noise = Noise(learn_edits(unknown, self.sound, self.vocab.select("w", "n")), seen)
        _settle(spark)
        # a file is printed if its pages are, taken together
        placed = page.select("sid", "score", F.col("lines").isNotNull().alias("near")).distinct().join(self.tasks, "sid")
        files = placed.groupBy("path").agg(F.sum("score").alias("score")).where("score > 0").select("path")
        inside = stored(placed.where("near").select("sid", "path", "idx").distinct().join(files, "path", "left_semi"))
        near = page.where("lines is not null").select("sid", "lines")
        self.marks = stored(furniture(near, inside, self.noise, fit_running(sample, self.noise)))
        _settle(spark)
        gone = self.marks.groupBy("sid", "path", "idx").agg(F.collect_set("no").alias("gone"))
        self.info = inside.join(gone, ["sid", "path", "idx"], "left")
        common = [r.tok for r in self.words.where("a > 0").orderBy(F.desc("a"), "tok").limit(COMMON).select("tok").collect()]
        body = near.join(self.info, "sid").select("sid", "path", "idx", "lines", "gone")
        self.body = stored(map_rows(body, _body_rows(spark.sparkContext.broadcast(frozenset(common)), middles), _BODY))
        _settle(spark)

    def broken(self) -> DataFrame:
        """(sid, path, idx, no, left, right, over); ``no`` counts body lines."""
        return broken_words(self.body, self.known, self.noise)

    def misread(self) -> DataFrame:
        """(sid, was, meant) of misread words and signs in body lines."""
        as_part = lambda c, part: F.transform(c, lambda w: F.struct(w.alias("w"), F.lit(part).alias("part")))
        seen = F.explode(F.concat(as_part("toks", False), as_part("parts", True))).alias("t")
        toks = stored(self.body.select("sid", seen).select("sid", "t.w", "t.part").distinct().join(self.words.where("a > 0").select(F.col("tok").alias("w")), "w", "left_anti"))
        words = misread_words(toks.groupBy("w").agg(F.count("*").alias("n")), self.vocab, self.sound, self.noise)
        # what may be part of a word only is misread where the edits are learned ones
        hits = toks.join(words, "w").where("learned or not part").select("sid", F.col("w").alias("was"), F.col("c").alias("meant"))
        wins = self.body.select("sid", F.explode("wins").alias("win")).distinct()
        signs = stored(misread_windows(wins.select("win").distinct(), self.signs, self.noise))
        _settle(wins.sparkSession)
        han = wins.join(signs, "win").select("sid", F.col("win").alias("was"), F.concat(F.substring("win", 1, 1), "put", F.substring("win", 3, 1)).alias("meant"))
        return hits.unionByName(han).distinct()

    def found(self) -> DataFrame:
        """(source_id, noise)."""
        kind = lambda d, k: d.select("sid", F.lit(k).alias("noise"))
        out = self.marks.select("sid", F.col("kind").alias("noise")).unionByName(kind(self.broken(), "hyphenation")).unionByName(kind(self.misread(), "misread"))
        return out.select(F.col("sid").alias("source_id"), "noise").distinct()

    def repaired(self) -> DataFrame:
        """(source_id, text): every scanned page as continuous paragraphs."""
        broken = checkpointed(self.broken())
        gone = self.marks.groupBy("sid").agg(F.collect_set("no").alias("gone"))
        within = broken.groupBy("sid").agg(F.collect_set(F.struct("left", "right")).alias("broken"), F.max(F.when(F.col("over"), F.col("right"))).alias("completes"))
        nxt = broken.where("over and right <> ''").select("path", (F.col("idx") + 1).alias("idx"), F.col("right").alias("first"))
        first = nxt.join(self.info, ["path", "idx"]).groupBy("sid").agg(F.max("first").alias("first"))
        fixes = self.misread().groupBy("sid").agg(F.collect_list(F.struct("was", "meant")).alias("fixes"))
        texts = self.sources.where(F.col(f"`{self.text}`").isNotNull()).select(F.col(f"`{self.key}`").alias("sid"), F.col(f"`{self.text}`").alias("text"))
        texts = texts.join(self.info.select("sid").distinct(), "sid", "left_semi").dropDuplicates(["sid"])
        for d in (gone, within, fixes, first):
            texts = texts.join(d, "sid", "left")
        return texts.select(F.col("sid").alias("source_id"), _repaired("text", "gone", "broken", "fixes", "completes", "first").alias("text"))
