"""Brown class-based n-gram scoring.

Exchange clustering assigns words to classes. The most frequent training words are clustered first:
word after word moves to the class that raises the likelihood of the class bigrams most, until
no word moves. Their number and the number of classes grow with the fourth root of the vocabulary
(``clustered_words``, ``class_count``). Then every other training word gets, in one job, the class of its best exchange gain, from the
counts of the classes beside it. So each training word has a class; the end of a text is a class of its own.

The probability of a text is the product over its tokens of the transition from the class before
(smoothed by a constant) and the emission of the word from its class (absolute discounting, the
discount from the numbers of words seen once and twice). What the discount leaves in the classes is the
probability of unknown words, spread evenly over the estimated number of unseen words; as a context an
unknown word stands for the classes by what they leave.

All training text is counted. The vocabulary with its classes is a distributed table and is
never gathered: words above a count threshold, at most ``HEAD`` of them, go to
the workers as a broadcast of that bounded size; pairs with other words are resolved by joins with the
vocabulary. As the frequent words are taken out before them, these joins have no hot key. ``HEAD`` changes only what is
joined, not the result. The clustering sees a matrix of the clustered words squared.

Words are compared by 64-bit codes. Defined results: a null text is an empty one
and has only its end token; repeated rows are scored row by row; without training
rows N and V are 0 and every base term is log10(1); an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import DOUBLE, LONG, field, id_remainder, load_documents, staged
from .shingles import word_codes

CLUSTERED = 64  # times the fourth root of the vocabulary
CLASSES = 3  # likewise
HEAD = 200_000
ROUNDS = 12  # of exchange at most
CHUNK = 2_000_000  # tokens counted at a time in a worker
SIDE = 1 << 40  # a class beside a word and how often it stands there, in one number
MOD, HELD_OUT = 7, 2


def _texts(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Word codes of each text of a batch, one at a time."""
    for value in batch.column(0):
        yield word_codes(value.as_py())


def vocabulary(train: DataFrame) -> DataFrame:
    """(code, c): how often each word occurs in the training texts. Summed per chunk, then per task, then over all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [], 0

        def counted():
            codes, n = np.unique(np.concatenate(kept), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(n.astype(np.int64))], names=["code", "n"])

        for batch in batches:
            for codes in _texts(batch):
                kept.append(codes)
                held += len(codes)
                if held >= CHUNK:
                    yield counted()
                    kept, held = [], 0
        if kept:
            yield counted()

    return staged(train.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("c")), "lm-vocabulary")


def frequent(vocab: DataFrame, limit: int = HEAD) -> tuple[np.ndarray, np.ndarray]:
    """(codes in order, counts) of the words above the lowest threshold that at most ``limit`` words pass."""
    step = F.floor(F.log2("c") * 8).cast("int")
    bins = sorted(((r["b"], r["n"], r["least"]) for r in vocab.groupBy(step.alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()), reverse=True)  # at most 8 * 64 rows
    total, least = 0, None
    for _, n, lowest in bins:
        if total + n > limit:
            break
        total, least = total + n, lowest
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    table = vocab.filter(F.col("c") >= least).toArrow()
    codes = table["code"].to_numpy().view(np.uint64)
    order = np.argsort(codes)
    return codes[order], table["c"].to_numpy()[order]


def bigrams(train: DataFrame, words: np.ndarray) -> np.ndarray:
    """Counts of neighbours among ``words`` (sorted codes), then rare, then end (also before the first word)."""
    k = len(words)
    shared = train.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((k + 2) * (k + 2), np.int64)
        for batch in batches:
            for codes in _texts(batch):
                ids = np.concatenate([[k + 1], places(codes, shared.value, k), [k + 1]])
                np.add.at(counts, ids[:-1] * (k + 2) + ids[1:], 1)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["at", "n"])

    table = train.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((k + 2) * (k + 2), np.int64)
    out[table["at"].to_numpy()] = table["n"].to_numpy()
    return out.reshape(k + 2, k + 2)


def places(codes: np.ndarray, table: np.ndarray, missing: int) -> np.ndarray:
    """Index of each code in the sorted ``table``, or ``missing``."""
    if not len(table):
        return np.full(len(codes), missing, np.int64)
    at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
    return np.where(table[at] == codes, at, missing)


def index(table: np.ndarray) -> tuple[np.uint64, np.ndarray]:
    """Where the codes of each leading bit pattern start in the sorted ``table``; about a code to four patterns."""
    bits = (4 * len(table)).bit_length()
    shift = np.uint64(64 - bits)
    return shift, np.searchsorted(table, np.arange(1 << bits, dtype=np.uint64) << shift)


def indexed_places(codes: np.ndarray, table: np.ndarray, starts: tuple[np.uint64, np.ndarray], missing: int) -> np.ndarray:
    """``places`` by ``index``: few steps from the first code of the same leading bits."""
    out = np.full(len(codes), missing, np.int64)
    if not len(table):
        return out
    open_, at = np.arange(len(codes)), starts[1][codes >> starts[0]]
    while len(open_):
        inside = at < len(table)
        open_, at = open_[inside], at[inside]
        there, sought = table[at], codes[open_]
        same = there == sought
        out[open_[same]] = at[same]
        further = there < sought
        open_, at = open_[further], at[further] + 1
    return out


def _entropy(x: np.ndarray) -> np.ndarray:
    """x log x, 0 at 0."""
    return x * np.log(np.maximum(x, 1))


def exchange(counts: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each row of the bigram matrix; the last two rows (rare, end) are classes of their own and stay.

    Words start by frequency rank modulo ``classes``. A word moves to the
    class with the greatest gain of sum n(c, d) log n(c, d) minus the left and
    right class totals' n log n, which is the class bigram likelihood up to a
    constant.
    """
    size = len(counts)
    k = size - 2
    classes = max(1, min(classes, k))
    n = counts.astype(float)
    # what stands behind and before each word: few of the columns
    behind = [(at, row[at]) for row in n[:k] for at in (np.flatnonzero(row),)]
    before = [(at, row[at]) for row in np.ascontiguousarray(n[:, :k].T) for at in (np.flatnonzero(row),)]
    label = np.empty(size, np.int64)
    order = np.argsort(-n[:k].sum(1), kind="stable")
    label[order] = np.arange(k) % classes
    label[k], label[k + 1] = classes, classes + 1
    c = classes + 2
    member = np.zeros((size, c))
    member[np.arange(size), label] = 1
    joint = member.T @ n @ member
    for _ in range(rounds if classes > 1 else 0):
        moved = 0
        for w in order.tolist():
            own = n[w, w]
            right = np.bincount(label[behind[w][0]], behind[w][1], c)  # counts of the class after w
            left = np.bincount(label[before[w][0]], before[w][1], c)
            old = label[w]
            right[old] -= own
            left[old] -= own
            # take w out
            joint[old] -= right
            joint[:, old] -= left
            joint[old, old] -= own
            rows, columns = joint.sum(1), joint.sum(0)
            # what putting it into each class changes
            r, l = np.flatnonzero(right), np.flatnonzero(left)
            now = joint[:classes, r]
            gain_row = (_entropy(now + right[r]) - _entropy(now)).sum(1)
            now = joint[l, :classes]
            gain_column = (_entropy(now + left[l, None]) - _entropy(now)).sum(0)
            diagonal = joint[np.arange(classes), np.arange(classes)]
            r, l = right[:classes], left[:classes]
            cross = (_entropy(diagonal + r + l + own) - _entropy(diagonal + r) - _entropy(diagonal + l) + _entropy(diagonal))
            total_right, total_left = right.sum() + own, left.sum() + own
            loss = (_entropy(rows[:classes] + total_right) - _entropy(rows[:classes])
                    + _entropy(columns[:classes] + total_left) - _entropy(columns[:classes]))
            gain = gain_row + gain_column + cross - loss
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            joint[new] += right
            joint[:, new] += left
            joint[new, new] += own
            if new != old:
                label[w] = new
                moved += 1
        if not moved:
            break
    return label


def clustered_words(vocabulary_size: int) -> int:
    return int(np.ceil(CLUSTERED * vocabulary_size ** 0.25))


def class_count(vocabulary_size: int) -> int:
    return int(np.ceil(CLASSES * vocabulary_size ** 0.25))


def contexts(train: DataFrame, words: np.ndarray, label: np.ndarray) -> DataFrame:
    """(code, beside: list of at * ``SIDE`` + n) of the words that are not clustered: how often each class stands behind (at)
    and before (at + number of classes) them. A list has at most two entries a class; a word has a row per chunk of tokens."""
    k, c = len(words), int(label.max()) + 1
    shared = train.sparkSession.sparkContext.broadcast((words, label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, class_of = shared.value
        codes, sides, held = [], ([], []), 0

        def counted():
            code = np.concatenate(codes)
            known = np.unique(code)
            at = indexed_places(code, known, index(known), 0) * (2 * c)
            key = np.sort(np.concatenate([at + np.concatenate(sides[0]), at + np.concatenate(sides[1])]))
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            n = np.diff(np.append(new, len(key)))
            word, side = np.divmod(key[new], 2 * c)
            offsets = np.searchsorted(word, np.arange(len(known) + 1)).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(side * SIDE + n))], names=["code", "beside"])

        for batch in batches:
            for found in _texts(batch):
                ids = np.concatenate([[k + 1], places(found, table, k), [k + 1]])
                other = np.flatnonzero(ids == k)
                codes.append(found[other - 1])
                sides[0].append(class_of[ids[other + 1]])
                sides[1].append(class_of[ids[other - 1]] + c)
                held += len(other)
                if held >= CHUNK:
                    yield counted()
                    codes, sides, held = [], ([], []), 0
        if held:
            yield counted()

    return train.select("text").mapInArrow(run, "code long, beside array<long>")


def best_class(joint: np.ndarray, classes: int, starts: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Class of the greatest exchange gain for words with entries (at, n) from ``starts[i]`` on; the first of equal ones."""
    c = len(joint)
    words = len(starts) - 1
    if not classes or not words:
        return np.zeros(words, np.int64)
    n = n.astype(float)
    behind = np.concatenate([joint[:classes], joint[:, :classes].T], axis=1).T  # what stands behind, then before, x class
    plain = _entropy(behind)
    once = _entropy(behind + 1) - plain  # most entries count 1
    gain = np.zeros((words, classes))
    low = 0
    while low < words:  # some words at a time, whose entries lie together
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + (1 << 21) // classes, "right")) - 1)
        part = slice(starts[low], starts[high])
        added = once[at[part]]
        many = np.flatnonzero(n[part] > 1)
        places_ = at[part][many]
        added[many] = _entropy(behind[places_] + n[part][many, None]) - plain[places_]
        filled = low + np.flatnonzero(starts[low + 1:high + 1] > starts[low:high])
        if len(filled):
            gain[filled] = np.add.reduceat(added, starts[filled] - starts[low], axis=0)
        low = high
    word = np.repeat(np.arange(words), np.diff(starts))
    side = np.zeros((2, words, classes))  # neighbours of the class itself on both sides share a cell
    for s, sums in enumerate((joint.sum(1), joint.sum(0))):
        mine = (at >= c) == bool(s)
        own = mine & (at % c < classes)
        side[s, word[own], at[own] % c] = n[own]
        totals, which = np.unique(np.bincount(word[mine], n[mine], words), return_inverse=True)
        gain -= (_entropy(sums[:classes] + totals[:, None]) - _entropy(sums[:classes]))[which]
    w, g = np.nonzero((side[0] > 0) & (side[1] > 0))
    diagonal, r, l = np.diagonal(joint)[g], side[0, w, g], side[1, w, g]
    gain[w, g] += _entropy(diagonal + r + l) - _entropy(diagonal + r) - _entropy(diagonal + l) + _entropy(diagonal)
    return gain.argmax(1)


def classified(beside: DataFrame, words: np.ndarray, counts: np.ndarray, label: np.ndarray, joint: np.ndarray) -> DataFrame:
    """(code, c, cls): the vocabulary with the class of every word. ``counts`` are those of ``words``, the clustered ones;
    the others occur as often as something stands behind them."""
    spark = beside.sparkSession
    k, c = len(words), len(joint)
    classes = int(label[k])
    shared = spark.sparkContext.broadcast(joint)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(code, packed):
            new = np.concatenate([[True], code[1:] != code[:-1]])
            key = (np.cumsum(new) - 1) * (2 * c) + packed // SIDE
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            n = np.add.reduceat(packed[order] % SIDE, first)
            word, at = np.divmod(key[first], 2 * c)
            starts = np.searchsorted(word, np.arange(np.count_nonzero(new) + 1))
            occurs = np.add.reduceat(np.where(at < c, n, 0), starts[:-1])
            cls = best_class(shared.value, classes, starts, at, n)
            return pa.RecordBatch.from_arrays([pa.array(code[new]), pa.array(occurs), pa.array(cls.astype(np.int32))],
                                              names=["code", "c", "cls"])

        codes, lists, held = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.asarray(batch["beside"].value_lengths())
            codes.append(np.repeat(batch["code"].to_numpy(), sizes))
            lists.append(batch["beside"].flatten().to_numpy())
            held += len(lists[-1])
            if held >= CHUNK // 8:
                code, packed = np.concatenate(codes), np.concatenate(lists)
                whole = np.searchsorted(code, code[-1])  # the last word may go on in the next batch
                if whole:
                    yield made(code[:whole], packed[:whole])
                codes, lists, held = [code[whole:]], [packed[whole:]], len(code) - whole
        if held:
            yield made(np.concatenate(codes), np.concatenate(lists))

    rest = beside.repartition("code").sortWithinPartitions("code").mapInArrow(run, "code long, c long, cls int")
    own = list(zip(words.view(np.int64).tolist(), counts.tolist(), label[:k].tolist(), strict=True))
    return staged(rest.unionByName(spark.createDataFrame(own, "code long, c long, cls int")), "lm-classes")


def neighbours(codes: np.ndarray, known: np.ndarray, starts: tuple[np.uint64, np.ndarray], class_of: np.ndarray, end: int):
    """(class before or -1, its word, class or -1, word) of each token of a text and its end; -1 where the word is not in the head."""
    at = indexed_places(codes, known, starts, -1)
    cls = np.concatenate([[end], np.where(at >= 0, class_of[at] if len(class_of) else 0, -1), [end]]).astype(np.int32)
    word = np.concatenate([[0], codes.view(np.int64), [0]]).astype(np.int64)
    word[cls >= 0] = 0
    return cls[:-1], word[:-1], cls[1:], word[1:], at


def tallied(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The distinct rows of ``columns`` and how often each occurs."""
    order = np.lexsort(columns)
    columns = [x[order] for x in columns]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([x[1:] != x[:-1] for x in columns], axis=0)
    first = np.flatnonzero(new)
    return [x[first] for x in columns] + [np.diff(np.append(first, len(order)))]


PAIRS = T.StructType([field("p", T.IntegerType()), field("p_code", LONG), field("t", T.IntegerType()), field("t_code", LONG),
                      field("n", LONG)])


def resolved(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` with the classes of words that the head lacks looked up: ``p`` and ``t`` stay -1 for unknown words; ``c`` is
    the count of the second word where it was looked up."""
    out = pairs.withColumn("c", F.lit(None).cast("long"))
    for side in ("p", "t"):
        table = classes.select(F.col("code").alias(f"{side}_code"), F.col("c").alias("_c"), F.col("cls").alias("_cls"))
        open_ = out.filter(F.col(side) < 0).join(table, f"{side}_code", "left").withColumn(side, F.coalesce("_cls", F.col(side)))
        if side == "t":
            open_ = open_.withColumn("c", F.col("_c"))
        out = out.filter(F.col(side) >= 0).unionByName(open_.drop("_c", "_cls"))
    return out


def transitions(train: DataFrame, codes: np.ndarray, class_of: np.ndarray, classes: DataFrame, c: int) -> np.ndarray:
    """Counts of (class before, class) over all training tokens and ends; class ``c`` is the end."""
    shared = train.sparkSession.sparkContext.broadcast((codes, class_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, labels = shared.value
        starts = index(known)
        counts = np.zeros((c + 1) ** 2, np.int64)
        kept, held, near, n_near = [], 0, [np.zeros(0, np.int64)], 0

        def counted(columns):
            table = pa.table(columns, names=["p", "p_code", "t", "t_code"])
            made = table.group_by(["p", "p_code", "t", "t_code"]).aggregate([([], "count_all")])
            return (made.select(["p", "p_code", "t", "t_code", "count_all"]).rename_columns(["p", "p_code", "t", "t_code", "n"])
                    .combine_chunks().to_batches())

        for batch in batches:
            for found in _texts(batch):
                p, pw, t, tw, _ = neighbours(found, known, starts, labels, c)
                both = (p >= 0) & (t >= 0)
                near.append(p[both].astype(np.int64) * (c + 1) + t[both])
                n_near += len(near[-1])
                if not both.all():
                    kept.append([x[~both] for x in (p, pw, t, tw)])
                    held += len(kept[-1][0])
                if held >= CHUNK:
                    yield from counted([np.concatenate(x) for x in zip(*kept, strict=True)])
                    kept, held = [], 0
                if n_near >= CHUNK:
                    counts += np.bincount(np.concatenate(near), minlength=len(counts))
                    near, n_near = [], 0
        if held:
            yield from counted([np.concatenate(x) for x in zip(*kept, strict=True)])
        if near:
            counts += np.bincount(np.concatenate(near), minlength=len(counts))
        counts = counts.reshape(c + 1, c + 1)
        p, t = np.nonzero(counts)
        nothing = np.zeros(len(p), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(nothing), pa.array(t.astype(np.int32)), pa.array(nothing),
                                          pa.array(counts[p, t])], names=["p", "p_code", "t", "t_code", "n"])

    pairs = staged(train.select("text").mapInArrow(run, PAIRS).groupBy("p", "p_code", "t", "t_code").agg(F.sum("n").alias("n")), "lm-pairs")
    out = np.zeros((c + 1, c + 1))
    for r in resolved(pairs, classes).groupBy("p", "t").agg(F.sum("n").alias("n")).collect():  # at most classes squared
        out[r["p"], r["t"]] = r["n"]
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mod: int = MOD, held_out: int = HELD_OUT,
          clustered: int | None = None, classes: int | None = None, head_words: int = HEAD, smoothing: float = 0.5) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``."""
    spark = docs.sparkSession
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                        (id_remainder(id_col, mod) == held_out).alias("held_out"))
    train = keyed.filter(~F.col("held_out"))
    vocab = vocabulary(train)
    sums = vocab.agg(F.sum("c"), F.count(F.lit(1)), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    ends = train.select("id").count()
    n_words, v_words, once, twice = (int(x or 0) for x in sums)
    n_all, v_all = n_words + ends, v_words + (ends > 0)
    clustered = clustered_words(v_words) if clustered is None else clustered
    codes, counts = frequent(vocab, max(head_words, 2 * clustered))
    top = np.sort(np.lexsort((codes, -counts))[:clustered])  # places in the head of the words to cluster
    words = codes[top]
    matrix = bigrams(train, words)
    label = exchange(matrix, class_count(v_words) if classes is None else classes)
    member = np.zeros((len(label), int(label.max()) + 1))
    member[np.arange(len(label)), label] = 1
    table = classified(contexts(train, words, label), words, counts[top], label, member.T @ matrix @ member)
    c = int(label[len(words)])  # classes of words; the end is class c, an unknown word as a context c + 1

    if len(codes):
        least = int(counts.min())
        head = table.filter(F.col("c") >= least).toArrow()  # the rows of ``codes``, so as bounded
        order = np.argsort(head["code"].to_numpy().view(np.uint64))
        class_of = head["cls"].to_numpy()[order]
    else:
        class_of = np.zeros(0, np.int32)
    mass, types = np.zeros(c), np.zeros(c)
    for r in table.groupBy("cls").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():  # a row per class
        mass[r["cls"]], types[r["cls"]] = r["n"], r["v"]
    discount = (once + 1) / (once + 2 * twice + 2)
    left = np.append(np.where(mass > 0, discount * types / np.maximum(mass, 1), 1.0), 0.0)  # the end leaves nothing
    unseen = max(1.0, once * (once - 1) / (2 * (twice + 1)))  # words not seen, as Chao estimates them
    joint = transitions(train, codes, class_of, table, c)
    joint = np.concatenate([joint, (left @ joint)[None]])
    chance = (joint + smoothing) / (joint.sum(1, keepdims=True) + smoothing * (c + 1))
    moves = np.log10(chance)  # row: class before, end or unknown; column: class or end
    unknown = np.log10(np.maximum(chance @ left, 1e-300) / unseen)
    class_log = np.log10(np.maximum(np.append(mass, 1.0), 1.0))
    emit = np.log10(counts - discount) - class_log[class_of]
    base_floor = float(np.log10(n_all + v_all + 1)) if n_all else 0.0
    model = spark.sparkContext.broadcast((codes, np.log10(counts + 1.0), emit, class_of, moves))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base, emission, labels, log_moves = model.value
        starts = index(known)
        for batch in batches:
            if not batch.num_rows:
                continue
            sums, open_ = [], []
            for found in _texts(batch.select(["text"])):
                p, pw, t, tw, at = neighbours(found, known, starts, labels, c)
                at = at[at >= 0]
                both = (p >= 0) & (t >= 0)
                open_.append(tallied([x[~both] for x in (p, pw, t, tw)]))
                sums.append((len(found) + 1, len(at), float(base[at].sum()),
                             float(log_moves[p[both], t[both]].sum() + emission[at].sum())))
            offsets = np.cumsum([0] + [len(x[0]) for x in open_]).astype(np.int32)
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in zip(*open_, strict=True)], names=PAIRS.names)
            columns = [pa.array(x) for x in zip(*sums, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["held_out"], *columns, pa.ListArray.from_arrays(pa.array(offsets), flat)],
                                             names=made.names)

    made = T.StructType([keyed.schema["id"], keyed.schema["held_out"], field("n_tokens", LONG), field("n_head", LONG),
                         field("head_base", DOUBLE), field("head_score", DOUBLE), field("pairs", T.ArrayType(PAIRS))])
    rows = staged(keyed.mapInArrow(run, made).withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    # pairs with words outside the head, by joins with the vocabulary
    pairs = resolved(rows.select("row", F.inline("pairs")), table)
    steps = [(p if p <= c else -1, t, float(moves[p, t] - class_log[t])) for p in range(c + 2) for t in range(c + 1)]
    steps += [(p if p <= c else -1, -1, float(unknown[p])) for p in range(c + 2)]
    step = spark.createDataFrame(steps, "p int, t int, step double")  # classes squared rows
    looked_up = F.col("t_code") != 0
    of_tail = F.when(F.col("c").isNotNull(), F.log10(F.col("c") - F.lit(discount)))
    # a head word or end behind a word that was looked up: its emission is in head_score, only the move is added
    of_head = F.when((F.col("t") >= 0) & ~looked_up, F.col("class_log"))
    logs = spark.createDataFrame([(t, float(class_log[t])) for t in range(c + 1)], "t int, class_log double")
    per_row = (pairs.join(F.broadcast(step), ["p", "t"]).join(F.broadcast(logs), "t", "left")
               .groupBy("row").agg(
                   F.sum(F.col("n") * (F.col("step") + F.coalesce(of_tail, of_head, F.lit(0.0)))).alias("tail_score"),
                   F.sum(F.when(F.col("c").isNotNull(), F.col("n") * F.log10(F.col("c") + 1))).alias("tail_log"),
                   F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("tail_known")))
    end_log = float(np.log10(ends + 1))
    return rows.drop("pairs").join(per_row, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_head") + F.coalesce("tail_known", F.lit(0)) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_log", F.lit(0.0)) + end_log - F.col("n_tokens") * base_floor).alias("base_score"),
        (F.col("head_score") + F.coalesce("tail_score", F.lit(0.0))).alias("score"))


def op5_class_lm(spark, sf_dir: str) -> DataFrame:
    """Base and model scores of every document."""
    return score(load_documents(spark, sf_dir))
