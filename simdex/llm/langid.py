"""Language identification (operator 7).

Method: a linear-chain conditional random field over the words of a text.
Affixes, byte n-grams and a lexicon give each word a score per language, learned
transitions tie neighbouring words together, and forward-backward gives every
word its posterior per language, so code-switched text is labelled word by word.
A document's language is the one with the largest posterior mass over its words;
its score is that language's mean posterior.

The field is trained on the driver from a bounded sample: ``TRAIN_DOCS`` whole
documents of each language (those with the smallest md5 of their id).  Their words
carry the document's language; runs of words of different documents are put
together so that the transitions see switches.  Prediction uses the text alone.

Words are runs of letters (ASCII letters and all characters beyond ASCII), folded to lower
case.  Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if
nothing can be learned (no labelled row); rows repeat as they come; other columns
are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import concat_ranges, small_batches, utf8

UND = "und"
TRAIN_DOCS = 250          # labelled documents of each language, at most
MAX_LANGS = 200           # languages that can be learned, the most frequent of the sample
RUN_WORDS = 48            # words of a training sequence
EPOCHS = 3
TABLE = 1 << 16           # weights of each hashed feature group
LEXICON_MIN = 3           # times the sample has a word of the lexicon
REACH, RESCALE = 60.0, 6  # largest gap of a word's scores; steps between rescalings
CHUNK_BYTES = 3_000_000   # text a task labels side by side


def held_out(doc_id: str | Column) -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


# -- words and features ------------------------------------------------------


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and for the Latin letters whose UTF-8 begins with xC3."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    if len(data) > 1:
        second = np.append(False, data[:-1] == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
        out[second] += 32
    return out


def words_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of letters, and how many there are per row."""
    letter = (data >= 128) | ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122))
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    before = np.append(False, letter[:-1]) if len(data) else letter
    starts = np.nonzero(letter & (~before | cut[:-1]))[0]
    after = np.append(letter[1:], False) if len(data) else letter
    ends = np.nonzero(letter & (~after | cut[1:]))[0] + 1
    return starts, ends, np.diff(np.searchsorted(starts, offs))


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(9)) % np.uint64(TABLE)


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word from running sums of its bytes' products with powers."""
    n = len(data)
    base = np.uint64(0x5851F42D4C957F2D)
    power = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, base)))
    run = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(7)) * power[:n]))
    inverse = pow(int(base), -1, 1 << 64)
    back = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, np.uint64(inverse))))
    return (run[ends] - run[starts]) * back[starts]


class Features:
    """The words of some texts and the hashed features of the distinct ones.

    ``which`` gives each word's distinct word; ``affix`` is (distinct words, 5); the n-grams of
    the distinct words lie end to end (``first`` is where each word's begin), ``TABLE`` where a
    word ends before the n-gram does."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        data = fold(data)
        starts, ends, self.counts = words_of(data, offs)
        self.hash, rep, self.which = np.unique(word_hash(data, starts, ends), return_index=True,
                                               return_inverse=True)
        s, e = starts[rep], ends[rep]
        self.size = size = e - s
        wide = np.append(data, np.zeros(4, np.uint8)).astype(np.uint64)

        def span(at, k):
            x = np.zeros(len(at), np.uint64)
            for j in range(k):
                x = x << np.uint64(8) | wide[at + j]
            return x
        three = lambda at: np.where(size > 2, span(np.maximum(at, 0), 3), np.uint64(0))
        self.affix = np.stack([_mix(span(s, 2), 11), _mix(three(s), 12),
                               _mix(span(np.maximum(e - 2, 0), 2), 13), _mix(three(e - 3), 14),
                               _mix(np.minimum(size, 30).astype(np.uint64), 15)], axis=1).astype(np.int64)
        at = concat_ranges(s, size)
        self.first = np.cumsum(size) - size
        left = np.repeat(size, size) - (at - np.repeat(s, size))
        self.gram2 = np.where(left >= 2, _mix(span(at, 2), 16).astype(np.int64), TABLE)
        self.gram3 = np.where(left >= 3, _mix(span(at, 3), 17).astype(np.int64), TABLE)


def _lexicon_at(lexicon: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each word in the sorted lexicon; its length (a row of zeros) if it isn't there."""
    if not len(lexicon):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return np.where(lexicon[at] == hashes, at, len(lexicon))


class Field:
    """Weights of the random field; ``scores`` gives each word's score per language."""

    def __init__(self, langs: list[str], lexicon: np.ndarray):
        k = len(langs)
        self.langs, self.lexicon = langs, lexicon
        self.affix = np.zeros((5, TABLE, k), np.float32)
        self.gram = np.zeros((2, TABLE + 1, k), np.float32)      # the last row stays zero
        self.lex = np.zeros((len(lexicon) + 1, k), np.float32)   # so does this one
        self.trans = np.eye(k) * 2.0

    def scores(self, f: Features) -> np.ndarray:
        """The score of every distinct word for every language."""
        out = self.lex[_lexicon_at(self.lexicon, f.hash)]
        for j in range(f.affix.shape[1]):
            out += self.affix[j][f.affix[:, j]]
        if len(out):
            out += np.add.reduceat(self.gram[0][f.gram2] + self.gram[1][f.gram3], f.first, axis=0) \
                / np.sqrt(f.size)[:, None].astype(np.float32)
        return out


def posteriors(scores: np.ndarray, counts: np.ndarray, trans: np.ndarray, with_pairs: bool = True
               ) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over sequences that lie end to end: each word's posteriors, and (if
    asked for) the expected number of each transition.

    Words are laid out by their place in the sequence, longer sequences first, so a step is a
    slice that holds exactly the sequences that reach it.  Scores are at most ``REACH`` apart,
    so sums of ``RESCALE`` steps stay within a double; they are scaled back that often."""
    k = scores.shape[1]
    order = np.argsort(-counts, kind="stable")
    order = order[:np.count_nonzero(counts)]
    starts, lens = (np.cumsum(counts) - counts)[order], counts[order]
    longest = int(lens[0]) if len(lens) else 0
    alive = np.searchsorted(-lens, -np.arange(longest), "left")  # sequences longer than t
    begin = np.append(0, np.cumsum(alive)).tolist()
    place = starts[concat_ranges(np.zeros(longest, np.int64), alive)] + np.repeat(np.arange(longest), alive)
    emit = scores[place].astype(np.float64)
    emit -= emit.max(axis=1, keepdims=True) if len(emit) else 0
    np.exp(np.maximum(emit, -REACH, out=emit), out=emit)
    move = np.exp(np.maximum(trans - trans.max(), -REACH / 4))
    fwd, bwd = np.empty_like(emit), np.empty_like(emit)
    back_move = np.ascontiguousarray(move.T)
    for t in range(longest):
        i, j = begin[t], begin[t + 1]
        if t:
            a = a[:j - i] @ move
            a *= emit[i:j]
        else:
            a = emit[i:j].copy()
        if t % RESCALE == 0:
            a /= a.sum(axis=1, keepdims=True)
        fwd[i:j] = a
    if longest:
        bwd[begin[-2]:] = 1.0
    for t in range(longest - 2, -1, -1):
        i, j, n = begin[t], begin[t + 1], begin[t + 2] - begin[t + 1]
        b = (emit[j:j + n] * bwd[j:j + n]) @ back_move
        if t % RESCALE == 0:
            b /= b.sum(axis=1, keepdims=True)
        bwd[i:i + n] = b
        bwd[i + n:j] = 1.0
    for x in (fwd, bwd):
        x /= x.sum(axis=1, keepdims=True)
    pairs = np.zeros((k, k))
    if with_pairs:
        for t in range(longest - 1):
            i, j, n = begin[t], begin[t + 1], begin[t + 2] - begin[t + 1]
            right = emit[j:j + n] * bwd[j:j + n]
            left = fwd[i:i + n]
            pairs += (left / (left * (right @ back_move)).sum(axis=1, keepdims=True)).T @ right * move
    fwd *= bwd
    fwd /= np.maximum(fwd.sum(axis=1, keepdims=True), 1e-300)
    out = np.empty_like(fwd)
    out[place] = fwd
    return out, pairs


# -- training ----------------------------------------------------------------


def train(samples: list[tuple[str, str]], *, epochs: int = EPOCHS, seed: int = 7) -> Field:
    """Fit by minibatch gradient steps (scaled by past gradients) on the log-likelihood."""
    langs = sorted({lang for _, lang in samples})
    joined = pa.array([t for t, _ in samples], pa.large_string())
    f = Features(*utf8(joined))
    label = np.repeat(np.array([langs.index(lang) for _, lang in samples], np.int64), f.counts)
    field = Field(langs, f.hash[np.bincount(f.which, minlength=len(f.hash)) >= LEXICON_MIN])
    lex = _lexicon_at(field.lexicon, f.hash)
    k, rng = len(langs), np.random.default_rng(seed)
    cuts = np.concatenate([np.arange(a, a + c, RUN_WORDS // 3) for a, c in
                           zip(np.cumsum(f.counts) - f.counts, f.counts)] or [np.zeros(0, np.int64)])
    stops = np.append(cuts[1:], len(label))
    sums = {name: np.full(getattr(field, name).shape, 1e-2, np.float32) for name in ("affix", "gram", "lex")}
    tsum = np.full((k, k), 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(cuts))  # three runs of any documents make a sequence
        for part in np.array_split(order, max(1, len(order) // 600)):
            runs = [np.arange(cuts[i], stops[i]) for i in part]
            runs = [np.concatenate(runs[i:i + 3]) for i in range(0, len(runs), 3)]
            words = np.concatenate(runs)
            counts = np.array([len(r) for r in runs], np.int64)
            used, at = np.unique(f.which[words], return_inverse=True)
            post, pairs = posteriors(_scores_of(field, f, lex, used)[at], counts, field.trans)
            grad = -post
            grad[np.arange(len(words)), label[words]] += 1
            seq = np.repeat(np.arange(len(runs)), counts)
            same = seq[1:] == seq[:-1]
            gold = np.zeros((k, k))
            np.add.at(gold, (label[words][:-1][same], label[words][1:][same]), 1)
            tsum += (gold - pairs) ** 2
            field.trans += 0.3 * (gold - pairs) / np.sqrt(tsum)
            _step(field, sums, f, lex, used, _sum_by(at, grad, len(used)))
    return field


def _sum_by(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(index, rows[:, c], n) for c in range(rows.shape[1])], axis=1)


def _grams_of(f: Features, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return concat_ranges(f.first[words], f.size[words]), np.repeat(np.arange(len(words)), f.size[words])


def _scores_of(field: Field, f: Features, lex: np.ndarray, words: np.ndarray) -> np.ndarray:
    out = field.lex[lex[words]].astype(np.float64)
    for j in range(f.affix.shape[1]):
        out += field.affix[j][f.affix[words, j]]
    at, row = _grams_of(f, words)
    per = field.gram[0][f.gram2[at]] + field.gram[1][f.gram3[at]]
    return out + _sum_by(row, per, len(words)) / np.sqrt(f.size[words])[:, None]


def _step(field, sums, f, lex, words, grad, rate: float = 0.3) -> None:
    """One scaled gradient step on every feature group that these distinct words touch."""
    at, row = _grams_of(f, words)
    spread = (grad / np.sqrt(f.size[words])[:, None])[row]
    groups = [(field.affix[j], sums["affix"][j], f.affix[words, j], grad) for j in range(f.affix.shape[1])]
    groups += [(field.gram[i], sums["gram"][i], g[at], spread) for i, g in enumerate((f.gram2, f.gram3))]
    groups.append((field.lex, sums["lex"], lex[words], grad))
    for weight, total, index, g in groups:
        real = index < len(weight) if weight.shape[0] == TABLE else index < len(weight) - 1
        used, back = np.unique(index[real], return_inverse=True)
        step = _sum_by(back, g[real], len(used))
        total[used] += step ** 2
        weight[used] += rate * step / np.sqrt(total[used])


def training_rows(docs: DataFrame, *, doc_id: str, text: str, lang: str,
                  per_lang: int = TRAIN_DOCS) -> list[tuple[str, str]]:
    """At most ``per_lang`` whole documents of each language, never a held-out one.

    The ids' md5 are chosen first, so only the chosen texts leave the executors."""
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    d = (docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(doc_id))
         .select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"),
                 key.alias("key")))
    first = W.partitionBy("lang").orderBy("key")
    langs = d.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS)
    cuts = {r["lang"]: r["cut"] for r in
            d.select("lang", "key").distinct().withColumn("rn", F.row_number().over(first))
            .where(F.col("rn") <= per_lang).groupBy("lang").agg(F.max("key").alias("cut"))
            .join(langs, "lang").collect()}
    if not cuts:
        return []
    cut = F.create_map(*(F.lit(x) for pair in sorted(cuts.items()) for x in pair))
    rows = (d.where(F.col("lang").isin(*cuts) & (F.col("key") <= F.element_at(cut, F.col("lang"))))
            .dropDuplicates(["lang", "key"]).orderBy("lang", "key").collect())
    return [(r["text"], r["lang"]) for r in rows if has_letter(r["text"])]


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Field | None:
    samples = training_rows(docs, doc_id=doc_id, text=text, lang=lang)
    return train(samples) if samples else None


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


# -- prediction --------------------------------------------------------------


def label_words(field: Field, texts: pa.Array) -> tuple[Features, np.ndarray]:
    """The words of some texts and each word's posterior per language."""
    f = Features(*utf8(texts))
    return f, posteriors(field.scores(f)[f.which], f.counts, field.trans, False)[0]


def _chunks(offs: np.ndarray) -> Iterator[tuple[int, int]]:
    row = 0
    while row < len(offs) - 1:
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + CHUNK_BYTES, "right")) - 1)
        yield row, end
        row = end


def predict(field: Field | None, texts: pa.Array) -> tuple[list[str], list[float]]:
    data, offs = utf8(texts)
    langs, scores = [UND] * len(texts), [0.0] * len(texts)
    if field is None:
        return langs, scores
    for a, b in _chunks(offs):
        f, post = label_words(field, texts.slice(a, b - a))
        if not len(post):
            continue
        run = np.concatenate([np.zeros((1, post.shape[1])), np.cumsum(post, axis=0)])
        ends = np.cumsum(f.counts)
        mass = run[ends] - run[ends - f.counts]
        best = mass.argmax(axis=1)
        for i in np.nonzero(f.counts)[0].tolist():
            part = data[offs[a + i]:offs[a + i + 1]]
            plain = (part < 128) & (part | 32 >= 97) & (part | 32 <= 122)
            if plain.any() or has_letter(part.tobytes().decode("utf-8", "replace")):
                langs[a + i] = field.langs[best[i]]
                scores[a + i] = float(min(1.0, mass[i, best[i]] / f.counts[i]))
    return langs, scores


def identify(docs: DataFrame, field: Field | None, *, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of every row, then ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # bounded: tables of fixed size per language
    rows = docs.select(*(F.col(c) for c in keep), F.col(text).cast("string").alias("__text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes), "lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            langs, scores = predict(field, batch.column(len(keep)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, "lang_pred", "score"])
    return small_batches(rows).mapInArrow(run, schema)


def language_id(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row."""
    field = fit(docs, doc_id=doc_id, text=text, lang=lang)
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return identify(d, field, keep=("doc_id",)).select("doc_id", held_out("doc_id").alias("held_out"),
                                                       "lang_pred", "score")
