"""Masked pseudo-likelihood: every token predicted from both sides by a window network in numpy.

Vocabulary: words (lower case, cut at white space) are counted over all documents; the `TOP` most frequent have
ids of their own and the others share `BUCKETS` hashed ids. Ids fall into classes of `MEMBERS` in
frequency order.

Network: h = tanh(sum over the 2 x `REACH` neighbours of T_j[id] + b); then
log P(id) = log softmax(h U + a)[class] + log softmax(h M_class + c_class)[member], normalised exactly over
all ids. A hashed id's probability is split by corpus counts: a word that was counted n times has n / (N + 1) of it, N
being the counts of all words of the id, and a word that was never counted the 1 / (N + 1) left over. These counts
grow with the corpus; they stay in a stored table and are joined to the rare words of each document. The `NEAR` most frequent of them
travel with the vocabulary, which spares most of that join. A document's
score is the sum over its tokens; outside its ends stands a padding id.

Training covers every position of every document once: a hash of id and text deals each document to a share of about
`SHARE` tokens, and every share to one of the rounds. In a round each share is learnt with Adagrad, in an order that hangs on the
hashes alone, from the same parameters; the shares' changes are averaged, row by row of the tables weighed by how often a
share touched the row, in a tree of shuffled sums. Shares hang on the data and not on its partitions, so neither do the scores,
but for the order of float sums. What reaches the driver is one set of parameters; what is gathered for it
grows with the input. Texts are turned into ids once and stored for the rounds.

Edge cases: null and empty texts have 0 tokens, sum 0.0 and a null mean; a text of any length is scored whole in
slices; repeated rows are scored (and trained on) each; a null id is passed on; other columns are not read; an empty
table gives no rows. Rows that repeat both id and text are learnt in one share.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.text import keep_columns
from eventmart.session import stage

TOP, BUCKETS = 3072, 1024
MEMBERS = 64
REACH = 2
HIDDEN = 16
ROUNDS = 4
RATE = 0.1
BATCH = 8192
SHARE = 1 << 20
NEAR = 1 << 17
SLICE = 1 << 14
WORDS_HELD = 300_000
FLUSH = 200_000
UNITS = 1 << 24

SIZE = TOP + BUCKETS
CLASSES = SIZE // MEMBERS
PAD = SIZE
OFFSETS = [*range(-REACH, 0), *range(1, REACH + 1)]

Params = dict[str, np.ndarray]


def start(counts: np.ndarray, seed: int = 11) -> Params:
    """First parameters: small random tables; the biases say the corpus frequencies of classes and members."""
    rng = np.random.default_rng(seed)
    freq = (counts + 1.0).reshape(CLASSES, MEMBERS)
    total = freq.sum(axis=1, keepdims=True)
    return {
        "T": rng.normal(0, 0.3, (len(OFFSETS), SIZE + 1, HIDDEN)).astype(np.float32),
        "b": np.zeros(HIDDEN, np.float32),
        "U": rng.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32),
        "a": np.log(total[:, 0] / total.sum()).astype(np.float32),
        "M": rng.normal(0, 0.1, (CLASSES, HIDDEN, MEMBERS)).astype(np.float32),
        "c": np.log(freq / total).astype(np.float32),
    }


def _exps(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The logarithms of the row sums of exp(x), and the sums by which the overwritten `x` is still to be divided."""
    shift = 0.0
    # Subtracting the row maximum takes longer than the rest; it is needed for extreme numbers only.
    if len(x) and not (x.max() < 60 and x.min() > -60):
        shift = x.max(axis=1)
        x -= shift[:, None]
    sums = np.exp(x, out=x) @ np.ones(x.shape[1], x.dtype)
    return np.log(sums) + shift, sums


def _with_bias(p: Params, table: str, bias: str) -> np.ndarray:
    return np.concatenate((p[table], p[bias][..., None, :]), axis=-2)


def _by_class(target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts targets by class, and where the classes begin in it."""
    kind = (target // MEMBERS).astype(np.uint8)
    return np.argsort(kind, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(kind, minlength=CLASSES))))


def _member_scores(h: np.ndarray, tables: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty((len(h), MEMBERS), h.dtype)
    for k in np.flatnonzero(np.diff(ends)).tolist():
        np.matmul(h[ends[k] : ends[k + 1]], tables[k], out=out[ends[k] : ends[k + 1]])
    return out


def _hidden(p: Params, context: np.ndarray) -> np.ndarray:
    columns = np.ascontiguousarray(context.T)
    z = np.take(p["T"][0], columns[0], axis=0)
    for j in range(1, len(OFFSETS)):
        z += np.take(p["T"][j], columns[j], axis=0)
    z += p["b"]
    return np.tanh(z, out=z)


def _hidden_one(p: Params, context: np.ndarray) -> np.ndarray:
    """The hidden layer and a column of ones, which stands for the biases."""
    h = _hidden(p, context)
    return np.concatenate((h, np.ones((len(h), 1), h.dtype)), axis=1)


def log_prob(p: Params, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log P(target | context) of each row, a slice at a time."""
    out = np.empty(len(target), np.float64)
    classes, members = _with_bias(p, "U", "a"), _with_bias(p, "M", "c")
    for at in range(0, len(target), SLICE):
        order, ends = _by_class(target[at : at + SLICE])
        t = target[at : at + SLICE][order]
        h, own = _hidden_one(p, context[at : at + SLICE][order]), np.arange(len(t))
        x = h @ classes
        score = x[own, t // MEMBERS].astype(np.float64)
        score -= _exps(x)[0]
        x = _member_scores(h, members, ends)
        score += x[own, t % MEMBERS]
        score -= _exps(x)[0]
        out[at + order] = score
    return out


def _dense_gradients(p: Params, context: np.ndarray, target: np.ndarray) -> tuple[float, Params]:
    """Mean loss and gradients of all parameters."""
    order, ends = _by_class(target)
    context, target = context[order], target[order]
    n, own, kind, member = len(target), np.arange(len(target)), target // MEMBERS, target % MEMBERS
    classes, members = _with_bias(p, "U", "a"), _with_bias(p, "M", "c")
    h = _hidden_one(p, context)
    d = h @ classes
    loss = -float(d[own, kind].sum())
    logs, sums = _exps(d)
    loss += float(logs.sum())
    # Rows come by class: the division and the target's 1 go into the narrow sides of the products.
    grad_u = (h / sums[:, None]).T @ d
    dh = d @ classes.T
    dh /= sums[:, None]
    d = _member_scores(h, members, ends)
    loss -= float(d[own, member].sum())
    logs, sums = _exps(d)
    loss += float(logs.sum())
    d /= sums[:, None]
    d[own, member] -= 1
    grad_m = np.zeros_like(members)
    for k in np.flatnonzero(np.diff(ends)).tolist():
        a, b = ends[k], ends[k + 1]
        np.matmul(h[a:b].T, d[a:b], out=grad_m[k])
        dh[a:b] += d[a:b] @ members[k].T - classes[:, k]
        grad_u[:, k] -= h[a:b].sum(axis=0)
    grad_m /= n
    h, dz = h[:, :-1], dh[:, :-1]
    dz = dz * (1 - h * h) / n
    grad = {"b": dz.sum(axis=0), "U": grad_u[:-1] / n, "a": grad_u[-1] / n, "M": grad_m[:, :-1], "c": grad_m[:, -1]}
    cells, flat = np.arange(HIDDEN), dz.ravel()
    grad["T"] = np.stack(
        [
            np.bincount((c[:, None] * HIDDEN + cells).ravel(), flat, (SIZE + 1) * HIDDEN).reshape(SIZE + 1, HIDDEN).astype(dz.dtype)
            for c in context.T
        ]
    )
    return loss / n, grad


def gradients(p: Params, context: np.ndarray, target: np.ndarray) -> tuple[float, Params, list[tuple[np.ndarray, np.ndarray]]]:
    """Mean loss, dense gradients, and of each table the rows touched and their gradients."""
    loss, grad = _dense_gradients(p, context, target)
    table = grad.pop("T")
    return loss, grad, [(ids := np.unique(context[:, j]), table[j][ids]) for j in range(len(OFFSETS))]


def train(p: Params, examples: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[Params, Params, int]:
    """New parameters after one pass, how often each row was touched, and the number of examples."""
    p = {k: p[k].copy() for k in p}
    past = {k: np.full(v.shape, 1e-4, np.float32) for k, v in p.items()}
    touched = {k: np.zeros(v.shape[:1] if k in ("M", "c") else v.shape[:2] if k == "T" else (), np.float32) for k, v in p.items()}
    n = 0
    for context, target in examples:
        _, grad = _dense_gradients(p, context, target)
        n += len(target)
        seen = np.bincount(target // MEMBERS, minlength=CLASSES)
        for k, g in grad.items():
            past[k] += g * g
            p[k] -= RATE * g / np.sqrt(past[k])
            if k != "T":
                touched[k] += seen if k in ("M", "c") else len(target)
        for j in range(len(OFFSETS)):
            touched["T"][j] += np.bincount(context[:, j], minlength=SIZE + 1)
    return p, touched, n


class Ids:
    """Numbers of a text's words and their ids; words outside the vocabulary are remembered up to a bound.

    `words` are those with ids of their own and then those whose counts are at hand.
    """

    def __init__(self, words: list[str]):
        from xxhash import xxh64_intdigest

        self.hash = xxh64_intdigest
        self.words = words
        self.reset()

    def reset(self) -> None:
        self.known = {w: i for i, w in enumerate(self.words)}
        # The hash that Spark's xxhash64 gives, so that plans can tell a word's hashed id too.
        near = [TOP + self.hash(w, 42) % BUCKETS for w in self.words[TOP:]]
        self.ids = np.zeros(max(1, 2 * (len(self.words) + WORDS_HELD)), np.uint16)
        own = min(TOP, len(self.words))
        self.ids[:own] = np.arange(own)
        self.ids[own : len(self.words)] = near

    def learn(self, word: str) -> int:
        self.known[word] = n = len(self.known)
        if n == len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[n] = TOP + self.hash(word, 42) % BUCKETS
        return n

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self.known) > len(self.words) + WORDS_HELD:
            self.reset()
        out = list(map(self.known.get, words))
        if None in out:
            known, learn = self.known, self.learn
            out = [(known[w] if w in known else learn(w)) if i is None else i for i, w in zip(out, words)]
        return np.array(out, np.int32)

    def __call__(self, text: str | None) -> np.ndarray:
        return self.ids[self.numbers((text or "").lower().split())].astype(np.int32)


def contexts(ids: np.ndarray) -> np.ndarray:
    """The neighbours of every position of one text."""
    padded = np.concatenate((np.full(REACH, PAD, np.int32), ids, np.full(REACH, PAD, np.int32)))
    return np.stack([padded[REACH + o : REACH + o + len(ids)] for o in OFFSETS], axis=1)


def word_counts(df: DataFrame) -> DataFrame:
    """`word, n` over all documents, summed within tasks before the shuffle."""

    def run(batches):
        counts: Counter[str] = Counter()

        def flush():
            out = pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                counts.update((text.as_py() or "").lower().split())
                if len(counts) > FLUSH:
                    yield flush()
        yield flush()

    return keep_columns(df, ["text"]).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def encoded(df: DataFrame, words: list[str], counts: np.ndarray) -> DataFrame:
    """`row, doc_id, ids, near, rare` of every row, stored.

    `ids` are the ids of its words as 16-bit numbers, `near` the sum of `log_units` over its words of hashed ids whose counts are at hand, `rare` its
    other words of hashed ids with how often it has them.
    """
    shared = df.sparkSession.sparkContext.broadcast((words, log_units(counts)))  # at most TOP + NEAR words

    def run(batches):
        words, units = shared.value
        to_ids, at_hand = Ids(words), len(words)
        units = np.concatenate((np.where(np.arange(at_hand) < TOP, 0, units), [0]))
        for batch in batches:
            ids, near, found, counts, ends = [], [], [], [], [0]
            for text in batch.column(1):
                said = (text.as_py() or "").lower().split()
                own = to_ids.numbers(said)
                ids.append(to_ids.ids[own].astype("<u2").tobytes())
                near.append(int(units[np.minimum(own, at_hand)].sum()))
                rare = Counter([said[i] for i in np.flatnonzero(own >= max(TOP, at_hand)).tolist()])
                found.extend(rare)
                counts.extend(rare.values())
                ends.append(len(found))
            pairs = pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])
            rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary()), pa.array(near, pa.int64()), rare], ["doc_id", "ids", "near", "rare"])

    kind = df.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary, near bigint, rare array<struct<word:string,n:bigint>>"
    out = keep_columns(df, ["doc_id", "text"]).mapInArrow(run, schema)
    return stage(out.withColumn("row", F.monotonically_increasing_id()))


def log_units(counts: np.ndarray) -> np.ndarray:
    """Logarithms in whole units, so that the order of sums does not show."""
    return np.round(np.log(np.maximum(counts, 1)) * UNITS).astype(np.int64)


def _ids_of(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py(), "<u2").astype(np.int32)


def _minibatches(texts: Iterator[np.ndarray]):
    """Minibatches of (contexts, targets) over all positions of encoded texts."""
    held_c, held_t, n = [], [], 0
    for ids in texts:
        held_c.append(contexts(ids))
        held_t.append(ids)
        n += len(ids)
        if n >= 8 * BATCH:
            c, t = np.concatenate(held_c), np.concatenate(held_t)
            full = n - n % BATCH
            for a in range(0, full, BATCH):
                yield c[a : a + BATCH], t[a : a + BATCH]
            held_c, held_t, n = [c[full:]], [t[full:]], n - full
    if n:
        c, t = np.concatenate(held_c), np.concatenate(held_t)
        for a in range(0, n, BATCH):
            yield c[a : a + BATCH], t[a : a + BATCH]


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
    """Each share of a partition sorted by share, with its texts; a share is to be used up before the next."""
    rows = ((s, v) for b in batches for s, v in zip(b.column(0).to_pylist(), b.column(1)))
    for share, own in itertools.groupby(rows, key=lambda x: x[0]):
        yield share, (_ids_of(v) for _, v in own)


NAMES = ("T", "b", "U", "a", "M", "c")


def _spread(weight: np.ndarray, like: np.ndarray) -> np.ndarray:
    return weight.reshape(weight.shape + (1,) * (like.ndim - weight.ndim))


def frequent(counted: DataFrame, most: int) -> DataFrame:
    """The words of the highest counts, `most` at most: all that reach a threshold.

    The threshold comes from a histogram, of a row per count up to 1,024 and 64 a power of two beyond.
    """
    step = F.when(F.col("n") <= 1024, F.col("n").cast("double")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2("n") * 64) / 64))
    bins = sorted(counted.groupBy(step.alias("at")).agg(F.count("*").alias("words")).collect(), reverse=True)
    total, least = 0, None
    for at, words in bins:
        if total + words > most:
            break
        total, least = total + words, at
    return counted.where(step >= F.lit(least)) if least is not None else counted.limit(0)


def vocabulary(df: DataFrame) -> tuple[list[str], Params, DataFrame, np.ndarray, np.ndarray]:
    """Words with ids of their own and then more whose counts are at hand, first parameters, the stored counts of all words, each hashed id's count, the words' counts."""
    from xxhash import xxh64_intdigest

    counted = stage(word_counts(df))
    best = [tuple(r) for r in frequent(counted, TOP + NEAR).select("word", "n").collect()]
    if len(best) < TOP:
        # The next count has too many words: the first of them by name.
        below = counted.where(F.col("n") < min((n for _, n in best), default=1 << 62))
        best += [tuple(r) for r in below.orderBy(F.col("n").desc(), "word").limit(TOP - len(best)).select("word", "n").collect()]
    best.sort(key=lambda x: (-x[1], x[0]))
    words, known = [w for w, _ in best], np.array([n for _, n in best], np.float64)
    own = words[:TOP]
    counts = np.zeros(SIZE)
    counts[: len(own)] = known[:TOP]
    # A hashed id has the counts of its words but those with an id of their own.
    bucket = F.xxhash64("word").bitwiseAND(F.lit(BUCKETS - 1))
    totals = counted.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")).toArrow()  # a row per hashed id
    hashed = np.zeros(BUCKETS)
    hashed[totals.column(0).to_numpy()] = totals.column(1).to_numpy()
    np.subtract.at(hashed, [xxh64_intdigest(w, 42) % BUCKETS for w in own], counts[: len(own)])
    counts[TOP:] = hashed
    return words, start(counts), counted, hashed, known


def dealt(encoded_rows: DataFrame, rounds: int) -> tuple[DataFrame, int]:
    """`ids, doc_id, order, share`, each row in one share, and the number of shares a round; share s is of round s % rounds."""
    tokens = encoded_rows.agg(F.sum(F.octet_length("ids") / 2)).first()[0] or 0
    a_round = max(1, math.ceil(tokens / rounds / SHARE))
    order = F.xxhash64("doc_id", "ids")
    return encoded_rows.select("ids", "doc_id", order.alias("order"), F.pmod(order, F.lit(rounds * a_round)).alias("share")), a_round


def trained(encoded_rows: DataFrame, p: Params, rounds: int = ROUNDS) -> Params:
    """Parameters after `rounds` passes over encoded rows, each over its own shares of them."""
    p = dict(p)
    sc = encoded_rows.sparkSession.sparkContext
    shares, a_round = dealt(encoded_rows, rounds)
    for round_no in range(rounds):
        shared = sc.broadcast(p)  # parameters: of fixed size, 1.3 MB
        own = shares.where(F.pmod("share", F.lit(rounds)) == round_no).repartition(a_round, "share").sortWithinPartitions("share", "order", "doc_id")

        def run(batches, shared=shared):
            old = shared.value
            for _, texts in _shares(batches):
                new, touched, n = train(old, _minibatches(texts))
                if n:
                    change = [((new[k] - old[k]) * _spread(touched[k], old[k])).tobytes() for k in NAMES]
                    weight = [touched[k].tobytes() for k in NAMES]
                    yield pa.record_batch([pa.array([b"".join(change)]), pa.array([b"".join(weight)])], ["change", "weight"])

        def plus(x, y):
            return x[0] + y[0], x[1] + y[1]

        changes = own.select("share", "ids").mapInArrow(run, "change binary, weight binary").rdd.map(
            lambda r: (np.frombuffer(r[0], np.float32), np.frombuffer(r[1], np.float32))
        )
        empty = (np.zeros(1, np.float32), np.zeros(1, np.float32))
        change, weight = changes.treeAggregate(empty, plus, plus, depth=3)
        if len(change) == 1:
            continue
        at = w = 0
        for k in NAMES:
            shape = p[k].shape[:2] if k == "T" else p[k].shape[:1] if k in ("M", "c") else ()
            size, rows = p[k].size, int(np.prod(shape))
            touched = _spread(weight[w : w + rows].reshape(shape), p[k])
            p[k] = p[k] + change[at : at + size].reshape(p[k].shape) / np.maximum(touched, 1)
            at, w = at + size, w + rows
        shared.unpersist()
    return p


Model = tuple[list[str], Params, DataFrame, np.ndarray, np.ndarray]


def fit(df: DataFrame, rounds: int = ROUNDS) -> Model:
    """The vocabulary and trained parameters, of fixed size, and word counts, of which the stored table grows with the corpus."""
    words, p, counted, hashed, known = vocabulary(df)
    return words, trained(encoded(df, words, known), p, rounds), counted, hashed, known


def scored(df: DataFrame, model: Model) -> DataFrame:
    """`doc_id, n_tokens, pseudo_log_likelihood, mean_log_prob` of every document."""
    return scored_rows(encoded(df, model[0], model[4]), model)


def fit_scored(df: DataFrame) -> DataFrame:
    """`scored` of every document under the network trained on all of them; ids are made once."""
    words, p, counted, hashed, known = vocabulary(df)
    rows = encoded(df, words, known)
    return scored_rows(rows, (words, trained(rows, p), counted, hashed, known))


def rare_sums(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """`row, own`: the sum of log n in whole units over the tokens of `rare`, n being a word's count in the corpus.

    Words met once or never add 0.
    """
    units = F.round(F.log("n_all") * F.lit(float(UNITS))).cast("long")
    known = counted.where("n > 1").select("word", F.col("n").alias("n_all"))
    rare = rows.select("row", F.inline("rare")).join(known, "word")
    return rare.groupBy("row").agg(F.sum(F.col("n") * units).alias("own"))


def scored_rows(rows: DataFrame, model: Model) -> DataFrame:
    """`scored` of encoded rows."""
    # Parameters and the hashed ids' shares: of fixed size.
    shared = rows.sparkSession.sparkContext.broadcast((model[1], np.concatenate((np.zeros(TOP), np.log(model[3] + 1)))))

    def run(batches):
        p, spread = shared.value
        for batch in batches:
            sums, sizes = [], []
            held, ends, n = [], [0], 0

            def close():
                if n:
                    targets = np.concatenate([t for _, t in held])
                    logs = log_prob(p, np.concatenate([c for c, _ in held]), targets) - spread[targets]
                    total = np.concatenate(([0.0], np.cumsum(logs)))
                else:
                    total = np.zeros(1)
                sums.extend((total[ends[1:]] - total[ends[:-1]]).tolist())
                sizes.extend(np.diff(ends).tolist())

            for value in batch.column(1):
                ids = _ids_of(value)
                held.append((contexts(ids), ids))
                n += len(ids)
                ends.append(n)
                if n >= 4 * SLICE:
                    close()
                    held, ends, n = [], [0], 0
            close()
            yield pa.record_batch(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())],
                ["row", "doc_id", "near", "n_tokens", "net"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    net = rows.select("row", "ids", "doc_id", "near").mapInArrow(run, f"row bigint, doc_id {kind}, near bigint, n_tokens bigint, net double")
    out = net.join(rare_sums(rows, model[2]), "row", "left")
    total = F.col("net") + (F.col("near") + F.coalesce("own", F.lit(0))) / F.lit(float(UNITS))
    mean = F.when(F.col("n_tokens") > 0, total / F.col("n_tokens"))
    return out.select("doc_id", "n_tokens", total.alias("pseudo_log_likelihood"), mean.alias("mean_log_prob"))
