"""Language identification by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary.  The
probability of a word is the sum over all its segmentations into pieces, taken
by the forward algorithm; a text's is the product over its words.  Piece
probabilities are fitted by expectation maximisation (forward-backward) on the
word counts of a bounded sample of labelled texts.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, id_bucket, session_of, stage, wider, worker_state

#: words up to this length need no scaling: no product of so many probabilities underflows
PLAIN = 16
#: longer words are scored one by one, position by position; the fit takes them in parts of this many code points
LONG = 256
#: positions between two scalings
STEPS = 8
#: words times positions of one lattice
CELLS = 1 << 17
UNKNOWN = 0
MEMO_WORDS = 400_000
UNDETERMINED = "und"


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def words_of(text: str) -> list[str]:
    """Lower-cased words with a leading word mark."""
    return ["▁" + w for w in text.lower().split()]


def lattice_parts(words: list[str]) -> Iterator[list[str]]:
    """Words of up to LONG code points, by length, in lists whose lattices are small."""
    words = sorted(words, key=len)
    i = 0
    while i < len(words):
        j = i + 1
        while j < len(words) and (j + 1 - i) * (len(words[j]) + 1) <= CELLS and (len(words[j]) <= PLAIN or len(words[i]) > PLAIN):
            j += 1
        yield words[i:j]
        i = j


class Pieces:
    """Ids of the vocabulary's pieces; 0 is any character that is no piece.

    ``get`` also holds every proper prefix of a piece (as -1), so that looking
    for longer pieces stops at the first substring that is not a key."""

    def __init__(self, vocabulary_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path)
        pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        kept = sorted({p for p in pieces if p == p.lower()})  # texts are lower-cased
        self.longest = max(map(len, kept), default=1)
        self.get: dict[str, int] = {}
        for p in kept:
            for j in range(1, len(p)):
                self.get.setdefault(p[:j], -1)
        self.get |= {p: i + 1 for i, p in enumerate(kept)}
        self.size = len(kept) + 1

    def starting(self, w: str, i: int) -> Iterator[tuple[int, int]]:
        """(end, id) of the pieces of ``w`` that start at ``i``; a character alone always is one."""
        get = self.get
        first = get.get(w[i], UNKNOWN)
        yield i + 1, max(first, UNKNOWN)
        if first == UNKNOWN:
            return
        for j in range(i + 2, min(i + self.longest, len(w)) + 1):
            p = get.get(w[i:j])
            if p is None:
                return
            if p > 0:
                yield j, p

    def lattice(self, words: list[str]) -> "Lattice":
        get, longest, word, begin, end, piece = self.get, self.longest, [], [], [], []
        for k, w in enumerate(words):
            n = len(w)
            for i in range(n):
                first = get.get(w[i], UNKNOWN)
                word.append(k)
                begin.append(i)
                end.append(i + 1)
                piece.append(max(first, UNKNOWN))
                if first == UNKNOWN:
                    continue
                for j in range(i + 2, min(i + longest, n) + 1):
                    p = get.get(w[i:j])
                    if p is None:
                        break
                    if p > 0:
                        word.append(k)
                        begin.append(i)
                        end.append(j)
                        piece.append(p)
        return Lattice(np.array([len(w) for w in words]), longest, *(np.array(x, np.int64) for x in (word, begin, end, piece)))

    def long_word_logs(self, w: str, p: np.ndarray) -> np.ndarray:
        """log probability of one word of any length; the state is what lies within one piece's reach."""
        ahead = np.zeros((self.longest + 1, p.shape[1]))  # ring of positions i, i + 1, ...
        ahead[0], scale, size = 1, np.zeros(p.shape[1]), self.longest + 1
        for i in range(len(w)):
            if i % STEPS == 0:
                most = ahead.max(0)
                ahead /= most
                scale += np.log(most)
            here = ahead[i % size].copy()
            ahead[i % size] = 0
            for j, piece in self.starting(w, i):
                ahead[j % size] += here * p[piece]
        return np.log(ahead[len(w) % size]) + scale


class Lattice:
    """All pieces of a list of words, as edges between character positions.

    Values of long words are scaled on the way; ``scale`` then holds the logs
    that belong to each position's values."""

    def __init__(self, lengths, longest, word, begin, end, piece):
        self.lengths, self.longest, self.width = lengths, longest, int(lengths.max(initial=0)) + 1
        self.word, self.begin, self.end, self.piece = word, begin, end, piece
        self.source, self.target, self.n = word * self.width + begin, word * self.width + end, len(lengths) * self.width
        self.first = np.arange(len(lengths)) * self.width
        self.last = self.first + lengths

    def _sweep(self, p: np.ndarray, start: np.ndarray, key: np.ndarray, source: np.ndarray, target: np.ndarray, down: bool) -> tuple[np.ndarray, np.ndarray | None]:
        values = np.zeros((self.n, p.shape[1]))
        values[start] = 1
        scale = np.zeros_like(values) if self.width > PLAIN + 1 else None
        if not len(key):
            return values, scale
        shape = (len(self.lengths), self.width, p.shape[1])
        total = np.zeros((len(self.lengths), p.shape[1]))
        order = np.lexsort((target, -key if down else key))
        key, source, target, prob = key[order], source[order], target[order], p[self.piece[order]]
        cuts = np.flatnonzero(np.diff(key)) + 1
        for step, (a, b) in enumerate(zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])), 1):
            t = target[a:b]
            starts = np.concatenate([[0], np.flatnonzero(np.diff(t)) + 1])
            at = t[starts]
            if scale is None:
                values[at] += np.add.reduceat(values[source[a:b]] * prob[a:b], starts)
                continue
            fresh = values[at] == 0  # where the sweep of a word starts, its one is there already
            values[at] += np.add.reduceat(values[source[a:b]] * prob[a:b], starts)
            scale[at] = np.where(fresh, total[at // self.width], scale[at])
            if step % STEPS == 0:
                here = int(key[a])
                reach = slice(here, here + self.longest) if down else slice(max(here - self.longest + 1, 0), here + 1)
                block = values.reshape(shape)[:, reach]
                most = block.max(1)
                most[most == 0] = 1  # words that end before or start after
                block /= most[:, None]
                scale.reshape(shape)[:, reach] += np.log(most)[:, None]
                total += np.log(most)
        return values, scale

    def forward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Per position, the probability of all segmentations of what lies before it. p: (pieces, languages)."""
        return self._sweep(p, self.first, self.end, self.source, self.target, False)

    def backward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        return self._sweep(p, self.last, self.begin, self.target, self.source, True)

    def word_logs(self, p: np.ndarray) -> np.ndarray:
        """log probability of each word in each language."""
        values, scale = self.forward(p)
        return np.log(values[self.last]) + (0 if scale is None else scale[self.last])

    def expected(self, p: np.ndarray, language: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
        """Expected piece counts (pieces, languages); each word counts for its own language."""
        (a, la), (b, lb) = self.forward(p), self.backward(p)
        lang = language[self.word]
        share = a[self.source, lang] * p[self.piece, lang] * b[self.target, lang] / a[self.last, language][self.word] * weight[self.word]
        if la is not None:
            share *= np.exp(la[self.source, lang] + lb[self.target, lang] - la[self.last, language][self.word])
        return np.bincount(self.piece * p.shape[1] + lang, share, size * p.shape[1]).reshape(size, -1)


def _pieces(path: str) -> Pieces:
    memo = worker_state()
    if ("pieces", path) not in memo:
        memo[("pieces", path)] = Pieces(path)
    return memo[("pieces", path)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, counts = arrow_schema({"lang": pa.string(), "word": pa.string(), "n": pa.int64()}), Counter()
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            counts.update((lang, w[i:i + LONG]) for w in words_of(text) for i in range(0, len(w), LONG))
    items = list(counts.items())
    for i in range(0, len(items), 16384):
        part = items[i:i + 16384]
        yield batch(schema, lang=[x[0][0] for x in part], word=[x[0][1] for x in part], n=[x[1] for x in part])


def _expect(path: str, p: np.ndarray, languages: list[str]):
    schema = arrow_schema({"piece": pa.int32(), "language": pa.int32(), "n": pa.float64()})
    place = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, total = _pieces(path), np.zeros_like(p)
        for b in batches:
            if b.num_rows:
                rows = {}
                for lang, word, n in zip(*(b.column(i).to_pylist() for i in range(3))):
                    rows.setdefault(word, []).append((place[lang], n))
                for part in lattice_parts([w for w, found in rows.items() for _ in found]):
                    language, n = zip(*(rows[w].pop() for w in part))
                    total += pieces.lattice(part).expected(p, np.array(language), np.array(n, float), len(p))
        i, j = np.nonzero(total)
        if len(i):
            yield batch(schema, piece=i.astype(np.int32), language=j.astype(np.int32), n=total[i, j])

    return run


class LanguageModel:
    def __init__(self, path: str, languages: list[str], p: np.ndarray, prior: np.ndarray):
        self.path, self.languages, self.p, self.prior, self.key = path, languages, p, prior, uuid.uuid4().hex


def sample_per_language(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int) -> DataFrame:
    """(lang, text) of at most ``rows`` labelled rows a language: those with the
    smallest hashes of id and text.  The counts of a first pass give the share
    of hashes that holds them, so no language's rows meet in one window."""
    span = 1 << 32
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    h = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    counts = labelled.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("of"))
    share = F.least(F.lit(1.0), F.lit(1.5) * rows / F.col("of") + F.lit(64.0) / F.col("of"))
    picked = (labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), h.alias("h"))
              .join(F.broadcast(counts), "lang")  # one row a language; fit() bounds their number
              .where(F.pmod("h", F.lit(span)) < share * span))
    top = Window.partitionBy("lang").orderBy("h", "text")
    return picked.withColumn("r", F.row_number().over(top)).where(F.col("r") <= rows).select("lang", "text")


def fit(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = 1500, rounds: int = 4, max_languages: int = 200) -> LanguageModel | None:
    """Fit on at most ``sample_rows`` whole texts a language (a documented bound);
    None without labelled rows.  More than ``max_languages`` labels are an error."""
    spark = session_of(docs)
    share = {r[0]: r[1] for r in docs.where(F.col(lang_col).isNotNull()).groupBy(lang_col).count().limit(max_languages + 1).collect()}
    if len(share) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not share:
        return None
    languages = sorted(share)
    words = stage(sample_per_language(docs, id_col, text_col, lang_col, sample_rows)
                  .mapInArrow(_count_words, "lang string, word string, n long")
                  .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    # small and compute-bound: spread over the cluster's cores
    words = words.repartition(max(4, spark.sparkContext.defaultParallelism), "word")
    size = Pieces(vocabulary_path).size
    p = np.full((size, len(languages)), 1 / size)
    for _ in range(rounds):
        n = np.zeros_like(p)
        for r in (words.mapInArrow(_expect(vocabulary_path, p, languages), "piece int, language int, n double")
                  .groupBy("piece", "language").agg(F.sum("n").alias("n")).collect()):  # at most pieces x languages
            n[r[0], r[1]] = r[2]
        pooled = (n.sum(1) + 0.5) / (n.sum() + 0.5 * size)
        p = (n + 50 * pooled[:, None]) / (n.sum(0) + 50)
    prior = np.array([share[x] for x in languages], float)
    return LanguageModel(vocabulary_path, languages, p, np.log(prior / prior.sum()))


class Scorer:
    """Word log probabilities, kept per worker for the words it has met."""

    def __init__(self, model: LanguageModel):
        self.model, self.pieces = model, _pieces(model.path)
        self.reset()

    def reset(self):
        self.place, self.logs, self.used = {}, np.empty((1 << 14, len(self.model.languages))), 0

    def learn(self, words: list[str]) -> None:
        for part in lattice_parts(words):
            logs = self.pieces.lattice(part).word_logs(self.model.p)
            while self.used + len(part) > len(self.logs):
                self.logs = np.concatenate([self.logs, np.empty_like(self.logs)])
            self.logs[self.used:self.used + len(part)] = logs
            self.place.update(zip(part, range(self.used, self.used + len(part))))
            self.used += len(part)

    def text_logs(self, texts: list[str]) -> np.ndarray:
        """Sum of word log probabilities of each text, by language."""
        split = [words_of(t) for t in texts]
        if self.used > MEMO_WORDS:
            self.reset()
        out = np.zeros((len(texts), len(self.model.languages)))
        for k, ws in enumerate(split):
            if any(len(w) > LONG for w in ws):
                out[k] = sum(self.pieces.long_word_logs(w, self.model.p) for w in ws if len(w) > LONG)
                split[k] = [w for w in ws if len(w) <= LONG]
        new = set().union(*split) - self.place.keys()
        self.learn(sorted(new))
        get = self.place.__getitem__
        for k, ws in enumerate(split):
            if ws:
                out[k] += self.logs[np.fromiter(map(get, ws), np.int64, len(ws))].sum(0)
        return out


def _predict(model: LanguageModel | None, text_col: str, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        if model is not None:
            memo = worker_state()
            if memo.get("language", (None,))[0] != model.key:
                memo["language"] = (model.key, Scorer(model))
            scorer = memo["language"][1]
        for b in batches:
            texts = b.column(text_col).to_pylist()
            found, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            at = [i for i, t in enumerate(texts) if scorer is not None and has_letter(t)]
            for i in range(0, len(at), 512):
                part = at[i:i + 512]
                logs = scorer.text_logs([texts[k] for k in part]) + model.prior
                top = logs.argmax(1)
                best = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
                for k, t, s in zip(part, top, best):
                    found[k], scores[k] = model.languages[t], float(s)
            t = pa.Table.from_batches([b])
            if not keep_text:
                t = t.drop_columns([text_col])
            t = t.append_column("__lang_pred", pa.array(found, pa.string())).append_column("__score", pa.array(scores, pa.float64()))
            yield from t.to_batches()

    return run


def predict(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """All rows and columns of ``docs`` with ``__lang_pred`` and ``__score``
    (the predicted language's posterior).  ``und`` with score 0 where the text
    is null or has no letter, and everywhere without a model."""
    session_of(docs)
    out = wider((docs if keep_text else docs.drop(text_col)).schema, __lang_pred="string", __score="double")
    return docs.mapInArrow(_predict(model, text_col, keep_text), out)


def language_id(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                modulus: int = 3, held_out: int = 1, **options) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Learns from labelled rows outside the held-out fold; label, source and id
    are no inputs of a prediction.  Ties take the first label in order.  Null
    ids count as '' when folds are dealt; repeated rows are predicted alike; an
    empty table gives an empty result; other columns are ignored.
    """
    fold = id_bucket(modulus, id_col) == held_out
    model = fit(docs.where(~fold), vocabulary_path, id_col, text_col, lang_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), fold.alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, model, keep_text=False).select("doc_id", "held_out", F.col("__lang_pred").alias("lang_pred"), F.col("__score").alias("score"))
