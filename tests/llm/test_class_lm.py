import math
import re
import zlib
from collections import Counter

import numpy as np

from smoglake.llm import class_lm
from smoglake.llm.shingles import word_codes

UPPER = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)) + [None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def base_scores(rows):
    train = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(train.values()), len(train)
    for i, text in rows:
        found = tokens(text)
        yield i, held(i), len(found), sum(train[t] > 0 for t in found), n, sum(math.log10((train[t] + 1) / (n + v + 1)) for t in found)


def test_word_codes_follow_the_words():
    texts = ["Ab ab\tÄb \x0b x\x1cy", "", None, "é", "ab ab"]
    for a in texts:
        assert len(word_codes(a)) == len(tokens(a)) - 1
    assert len(set(word_codes("Ab ab AB").tolist())) == 1 and len(set(word_codes("Äb äb").tolist())) == 2


def test_indexed_places_equal_places():
    rng = np.random.default_rng(3)
    for size in (0, 1, 2, 50, 5000):
        table = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        close = np.unique(np.concatenate([table, np.arange(40, dtype=np.uint64), np.uint64(2 ** 64 - 1) - np.arange(40, dtype=np.uint64)]))
        for known in (table, close[::2]):
            sought = np.concatenate([close, rng.integers(0, 1 << 64, 300, dtype=np.uint64)])
            got = class_lm.indexed_places(sought, known, class_lm.index(known), -1)
            assert (got == class_lm.places(sought, known, -1)).all()


def likelihood(counts, label):
    c = label.max() + 1
    m = np.zeros((len(counts), c))
    m[np.arange(len(counts)), label] = 1
    joint = m.T @ counts @ m
    plain = lambda x: float((x[x > 0] * np.log(x[x > 0])).sum())
    return plain(joint) - plain(joint.sum(0)) - plain(joint.sum(1))


def test_exchange_reaches_a_local_optimum_and_finds_planted_classes():
    rng = np.random.default_rng(2)
    k = 24
    counts = np.zeros((k + 2, k + 2))
    for _ in range(6000):  # words of thirds follow one another in turn
        a = rng.integers(3)
        counts[a * 8 + rng.integers(8), (a + 1) % 3 * 8 + rng.integers(8)] += 1
    label = class_lm.exchange(counts.astype(np.int64), 3)
    assert all(len(set(label[s:s + 8])) == 1 for s in (0, 8, 16)) and len(set(label[:k])) == 3
    best = likelihood(counts, label)
    for w in range(k):
        for c in range(3):
            other = label.copy()
            other[w] = c
            assert likelihood(counts, other) <= best + 1e-6


def test_query_base_scores_and_model(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = {r.doc_id: r for r in class_lm.op5_class_lm(spark, sf).collect()}
    for i, is_held, n, known, total, base in base_scores(rows):
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (is_held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    test = [r for r in out.values() if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)  # the classes help on unseen texts


def test_small_head_and_joined_tail_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    big = {r.doc_id: r for r in class_lm.score(docs, clustered=50, classes=8).collect()}
    small = {r.doc_id: r for r in class_lm.score(docs, clustered=50, classes=8, head_words=60).collect()}
    for i, r in big.items():
        assert math.isclose(r.base_score, small[i].base_score, rel_tol=1e-9) and r.n_known == small[i].n_known
        assert math.isclose(r.score, small[i].score, rel_tol=1e-9)


def model_scores(rows, clustered, classes, smoothing=0.5):
    """Scores by dictionaries: clusters the head, then tries every class for every further word."""
    code = lambda w: int(word_codes(w)[0])
    train = [tokens(text) for i, text in rows if not held(i)]
    count = Counter(t for found in train for t in found if t is not None)
    head = sorted(count, key=lambda w: (-count[w], code(w)))[:clustered]
    place = {w: i for i, w in enumerate(sorted(head, key=code))}
    k = len(place)
    matrix = np.zeros((k + 2, k + 2), np.int64)
    for found in train:
        for a, b in zip([None, *found], found):
            matrix[k + 1 if a is None else place.get(a, k), k + 1 if b is None else place.get(b, k)] += 1
    label = class_lm.exchange(matrix, classes)
    c = int(label[k])
    member = np.eye(c + 2)[label]
    joint = member.T @ matrix @ member
    beside = {w: Counter() for w in count if w not in place}
    state = lambda w: c + 1 if w is None else int(label[place.get(w, k)])
    for found in train:
        for a, w, b in zip([None, *found], found, [*found[1:], None]):
            if w in beside:
                beside[w][state(a), True] += 1
                beside[w][state(b), False] += 1
    xlogx = lambda x: x * math.log(x) if x > 0 else 0.0
    cls = {w: int(label[i]) for w, i in place.items()}
    for w, near in beside.items():
        gains = []
        for g in range(c):
            new = joint.copy()
            for (x, before), n in near.items():
                new[(x, g) if before else (g, x)] += n
            gain = sum(xlogx(new[at]) - xlogx(joint[at]) for at in {(x, g) if before else (g, x) for x, before in near})
            total = count[w]
            gain -= xlogx(joint.sum(1)[g] + total) - xlogx(joint.sum(1)[g]) + xlogx(joint.sum(0)[g] + total) - xlogx(joint.sum(0)[g])
            gains.append(gain)
        cls[w] = max(range(c), key=lambda g: (gains[g] > max(gains) - 1e-9, -g))
    n1, n2 = sum(n == 1 for n in count.values()), sum(n == 2 for n in count.values())
    d = (n1 + 1) / (n1 + 2 * n2 + 2)
    mass = [sum(count[w] for w in count if cls[w] == g) for g in range(c)]
    left = [d * sum(g == cls[w] for w in count) / mass[g] if mass[g] else 1.0 for g in range(c)]
    moves = np.zeros((c + 2, c + 1))
    for found in train:
        for a, b in zip([None, *found], found):
            moves[c if a is None else cls[a], c if b is None else cls[b]] += 1
    moves[c + 1] = sum(left[g] * moves[g] for g in range(c))
    chance = (moves + smoothing) / (moves.sum(1, keepdims=True) + smoothing * (c + 1))
    unseen = max(1.0, n1 * (n1 - 1) / (2 * (n2 + 1)))
    for i, text in rows:
        found, out = tokens(text), 0.0
        for a, b in zip([None, *found], found):
            row = chance[c if a is None else cls.get(a, c + 1)]
            if b is None:
                out += math.log10(row[c])
            elif b in cls:
                out += math.log10(row[cls[b]] * (count[b] - d) / mass[cls[b]])
            else:
                out += math.log10(row[:c] @ left / unseen)
        yield i, out
    assert set(cls) == set(count)  # every training word has a class
    # each row of the model adds up to one: words of each class, what they leave, the end
    for row in chance:
        assert math.isclose(row[c] + sum(row[g] * ((mass[g] - d * sum(x == g for x in cls.values())) / mass[g] + left[g])
                                         for g in range(c) if mass[g]) + sum(row[g] for g in range(c) if not mass[g]), 1.0)


def test_score_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()][:25]
    rows += [(900_001, ""), (900_002, None), (900_003, "the unseenword zzzz the"), (900_004, "qq"), (900_004, "qq")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(model_scores(rows, 60, 6))
    for head_words in (class_lm.HEAD, 150):
        got = sorted((r.doc_id, r.score) for r in class_lm.score(docs, clustered=60, classes=6, head_words=head_words).collect())
        for (i, a), (j, b) in zip(got, want, strict=True):
            assert i == j and math.isclose(a, b, rel_tol=1e-9), (i, head_words)


def test_awkward_rows(spark, awkward, awkward_rows, no_docs, clashing):
    assert class_lm.score(no_docs).count() == 0
    want = sorted((i is None, i or 0, n, known) for i, _, n, known, _, _ in base_scores([(r[0], r[1]) for r in awkward_rows]))
    for docs in (awkward, clashing):
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known) for r in class_lm.score(docs).collect()) == want
    only_held = spark.createDataFrame([(i, "a b") for i in range(60) if held(i)], "doc_id long, text string")
    assert {(r.train_tokens, r.n_known, r.base_score) for r in class_lm.score(only_held).collect()} == {(0, 0, 0.0)}


def test_contexts_come_in_a_row_per_word(spark):
    """What stands beside a word is sent in one row for a task's texts, and its sums are those of a plain count."""
    from collections import Counter

    texts = ["a x b x x", "x a y", None, "y", "b y x a a"]
    words = np.sort(class_lm.word_codes("a b"))
    kind = {int(w): i for i, w in enumerate(words)}
    want = Counter()
    for text in texts:
        codes = class_lm.word_codes(text).tolist()
        cls = [3, *[kind.get(w, 2) for w in codes], 3]
        for i, w in enumerate(codes, 1):
            if cls[i] == 2:
                want[w, cls[i + 1]] += 1
                want[w, cls[i - 1] + 4] += 1
    rows = class_lm.contexts(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), words, np.arange(4)).collect()
    assert len(rows) == len({w for w, _ in want})
    assert {(r.code % (1 << 64), b // class_lm.SIDE): b % class_lm.SIDE for r in rows for b in r.beside} == want
