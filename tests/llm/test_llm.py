"""The training-data operators against brute force on small tables, odd rows included."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quorumtext.llm import exact_dedup, fingerprint, language_id, line_dedup, mixing, order_minhash, packing, quality_crf, queries, sharding, shingles, token_count, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, bin string, digest string, tokens string, row string, part string"


def table(spark, texts, **columns):
    """documents with columns whose names the operators use inside."""
    rows = [(i, t, columns.get("lang", [None] * len(texts))[i], columns.get("source", ["s"] * len(texts))[i], len(t or ""), "k", "b", "d", "t", "r", "p") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7)))
    prose = lambda n: "\n".join(" ".join(word() for _ in range(rng.randint(3, 14))) + "." for _ in range(n))
    base = [prose(rng.randint(1, 12)) for _ in range(60)]
    long = prose(400)
    near = base[3].split(" ")
    near[len(near) // 2] = "changed"
    return [*base, None, "", " \n\t ", None, base[0], base[0] + "  ", base[1], base[1].replace(" ", "\t"), " ".join(near), long, long + " tail", "x" * 5000, "a b c", "a b c", "é ß Σ ς 中文 <|endoftext|> don't 12", "1 2 3", "same " * 900, "same " * 880]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.tokenizer_path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


# 1


def test_counts_are_the_librarys(docs, texts, library):
    got = {r["doc_id"]: r for r in token_count.token_counts(docs).collect()}
    assert {i: (r["n_bytes"], r["n_tokens"]) for i, r in got.items()} == {i: (len((t or "").encode()), len(ids_of(library, t))) for i, t in enumerate(texts)}


def test_chunks_splice_and_widen(spark, library):
    rng = random.Random(3)
    parts = ["word", "don't", "x1y2", "…", "'s", "中文", "É", "<|endoftext|>", "ſſ", "y" * 90, " ", "  ", "\n", "!!", "12"]
    made = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(20, 400))) for _ in range(40)] + ["z" * 3000, "né" * 900, "!?" * 800]
    got = {r["doc_id"]: (r["n_tokens"], r["n_chunks"]) for r in token_count.token_counts(table(spark, made), huge_chars=60, chunk_chars=50, overlap=10, widen=2).collect()}
    assert {i: n for i, (n, _) in got.items()} == {i: len(ids_of(library, t)) for i, t in enumerate(made)}
    assert max(c for _, c in got.values()) > 5 and got[40][1] == 1  # a single word has no stable place: it is encoded whole at last


def test_encoder_on_odd_texts(library):
    rng = random.Random(5)
    letters = [*"abcXYZ019 \t\n.'!?<|>sÉßΣσİ", "\x1c", " ", "　", "é", "ſ", "②", "Ⅷ", "中", "<|endoftext|>", "'re", "'LL", "don't", "a" * 50, ""]
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    ids, counts = tokens.Encoder("word_bpe_49k.json").encode(pa.array(made))
    ends = np.cumsum(counts)
    for t, n, end in zip(made, counts, ends):
        assert ids[end - n : end].tolist() == ids_of(library, t), t


# 2


def test_patience_is_an_alignment():
    rng = random.Random(4)
    for _ in range(500):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        if a and b and a[0] == b[0]:
            assert (0, 0) in pairs


def brute_lines(texts, least, rare=None):
    """Every earlier document is aligned with every later one; with ``rare``, only the partners that the operator defines."""
    lines = []
    for t in texts:
        own = [(i, x.strip(" \t\r\v\f")) for i, x in enumerate((t or "").split("\n"))]
        lines.append([(n, i, x, len(x.split())) for n, (i, x) in enumerate((i, x) for i, x in own if x)])
    shared = {x for x, n in collections.Counter(x for d in lines for x in {x for _, _, x, _ in d}).items() if n > 1}
    seq = [[(n, x, w) for n, _, x, w in d if x in shared] for d in lines]
    at = collections.defaultdict(list)
    for d, own in enumerate(lines):
        for _, _, x, _ in own:
            at[x].append(d)
    out = []
    for d, t in enumerate(texts):
        gone = set()
        partners = range(d)
        if rare is not None:
            partners = {at[x][0] for _, _, x, _ in lines[d]}
            partners |= {p for _, _, x, _ in lines[d] if len(at[x]) <= rare for p, q in zip(at[x], at[x][1:]) if q == d}
        for p in sorted(set(partners) - {d}):
            gone |= set(line_dedup.blocks_to_delete(seq[d], seq[p], least))
        number = {n: i for n, i, _, _ in lines[d]}
        drop = {number[n] for n in gone}
        every = (t or "").split("\n")
        left = [x for i, x in enumerate(every) if i not in drop]
        out.append(t if not drop else "\n".join(left) if any(x.strip() for x in left) else "")
    return out


def test_line_dedup_is_brute_force(spark, texts, docs):
    shared = ["one two three four five six.", "this long line stands in many documents here.", "and another that follows it in each of them.", "short one."]
    rng = random.Random(9)
    made = list(texts)
    for k in range(30):
        made.append("\n".join([f"own line {k} a b c d.", *shared[: 1 + k % 4], f"own end {k} e f g.", *(rng.sample(shared, 2) if k % 5 == 0 else [])]))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(table(spark, made), rare=8).collect()}
    want = brute_lines(made, line_dedup.BLOCK_WORDS)
    # the brute force aligns with all, the operator with the first and the one before: what the operator deletes is a part
    for i, t in enumerate(made):
        kept, must = collections.Counter((got[i] or "").split("\n")), collections.Counter((want[i] or "").split("\n"))
        assert not must - kept
    assert got == dict(enumerate(brute_lines(made, line_dedup.BLOCK_WORDS, rare=8)))
    first = {}
    for i, t in enumerate(made):  # no line with words is lost for the corpus
        for x in (t or "").split("\n"):
            first.setdefault(x.strip(), i)
    everything = {x.strip() for t in got.values() for x in (t or "").split("\n")}
    assert set(first) - {""} <= everything


def test_a_run_of_short_lines_finds_its_first_holder(spark):
    short = [f"line {x}" for x in "abcdef"]
    alone = lambda name: [f"own {name} {k}\n{x}\nend {name} {k}" for k, x in enumerate(short)]
    block = "\n".join(short)
    made = [*alone("before"), f"start B\n{block}\nend B", *alone("between"), "\n".join(reversed(short)), f"start C\n{block}\nend C"]
    for rare in (line_dedup.RARE, 2):
        got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(table(spark, made), rare=rare).collect()}
        assert got == dict(enumerate(brute_lines(made, line_dedup.BLOCK_WORDS)))
        assert got[len(made) - 1] == "start C\nend C"


@pytest.mark.parametrize("at", [510, 511, 516])
def test_blocks_across_the_cuts_of_long_documents(spark, at):
    own = lambda name, n: [f"{name} {i}" for i in range(n)]
    for there in (at, 511):
        made = ["\n".join([*own("left", there), "shared one here", "shared two there", *own("left end", 600)]), "\n".join([*own("right", at), "shared one here", "shared two there", *own("right end", 600)])]
        rows = line_dedup.dedup_lines(table(spark, made)).where("n_deleted > 0").collect()
        assert [(r["doc_id"], r["n_deleted"]) for r in rows] == [(1, 2)]
        assert "shared" not in rows[0]["text"]


def test_units_of_any_size_find_the_same_blocks(spark, docs):
    whole = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs, unit_lines=10**6).select("doc_id", "text").collect())
    for lines in (7,):
        assert sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs, unit_lines=lines).select("doc_id", "text").collect()) == whole


def test_rows_with_equal_ids_and_clashing_names(spark):
    shared, own = "these are five shared words", "precious words that only this row has"
    rows = [(1, shared, 7, 8, 9, 1), (2, shared, 7, 8, 9, 2), (2, own, 7, 8, 9, 3), (2, shared, 7, 8, 9, 4), (3, own, 7, 8, 9, 5), (3, None, 7, 8, 9, 6)]
    made = spark.createDataFrame(rows, "doc_id long, text string, _gone int, gone int, mark int, own_id int")
    got = sorted(((r["own_id"], r["text"], r["_gone"], r["gone"], r["mark"]) for r in line_dedup.dedup_lines(made).collect()))
    assert got == [(1, shared, 7, 8, 9), (2, "", 7, 8, 9), (3, own, 7, 8, 9), (4, "", 7, 8, 9), (5, "", 7, 8, 9), (6, None, 7, 8, 9)]
    clash = made.withColumnRenamed("_gone", "n_lines").withColumnRenamed("gone", "n_deleted")
    assert line_dedup.dedup_lines(clash).where("n_deleted = 1 AND n_lines = 1").count() == 3
    kept = line_dedup.clean_documents(clash)
    assert kept.columns == clash.columns and sorted(r["own_id"] for r in kept.collect()) == [1, 3, 6]


def test_line_dedup_recall_with_all_partners(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r["text"] for r in docs.orderBy("doc_id").select("text").collect()]
    want = brute_lines(texts, line_dedup.BLOCK_WORDS)
    lost = lambda out: sum(len((a or "").split("\n")) - len((b or "").split("\n")) for a, b in zip(texts, out))
    got = [r["text"] for r in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()]
    assert lost(got) >= 0.98 * lost(want) > 500


def test_line_dedup_keeps_own_repeats_and_clean_texts(spark):
    made = ["a b c d e f\na b c d e f\nx", None, "p q r s t u\nonly here", "a b c d e f\nnew words stand here"]
    got = {r["doc_id"]: (r["text"], r["n_deleted"]) for r in line_dedup.dedup_lines(table(spark, made)).collect()}
    assert got == {0: (made[0], 0), 1: (None, 0), 2: (made[2], 0), 3: ("new words stand here", 1)}


# 3


def test_alignment_decides_like_the_full_table():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    rng = random.Random(5)
    for _ in range(600):
        k = rng.choice([2, 4, 30])
        a = [rng.randrange(k) for _ in range(rng.randint(1, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 8)):
            i = rng.randrange(len(b) + 1)
            b[i : i + rng.randrange(3)] = [rng.randrange(k)] * rng.randrange(3)
        if b:
            need = math.ceil(0.8 * (len(a) + len(b)) / 2 - 1e-9)
            n, m = lcs(a, b), order_minhash.aligned_words(np.array(a, np.uint64), np.array(b, np.uint64), need)
            assert (n >= need) == (m >= need) and (n < need or n == m)


def brute_near(rows):
    parent = {i: i for i in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    items = sorted(rows)
    for n, i in enumerate(items):
        for j in items[n + 1 :]:
            a, b = (rows[i] or "").split(), (rows[j] or "").split()
            if a and b and (a == b or order_minhash.similarity(rows[i], rows[j]) >= 0.8):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in items}


def test_near_groups_are_brute_force(spark, texts):
    rng = random.Random(8)
    made = list(texts)
    for base in ([f"w{rng.randrange(400)}" for _ in range(150)], [f"v{rng.randrange(90)}" for _ in range(60)]):
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randrange(5)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            made.append(" ".join(words))
    got = {r["doc_id"]: r for r in order_minhash.near_groups(table(spark, made)).collect()}
    want = brute_near(dict(enumerate(made)))
    assert {i: r["class_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["class_id"]) for i, r in got.items())


def test_unlike_heads_hide_no_pair(spark):
    rng = random.Random(12)
    own = lambda n: [f"o{rng.randrange(10**7)}" for _ in range(n)]
    base = [f"x{i}" for i in range(200)]

    def edited(places):
        words = list(base)
        for at in places:
            words[at] = own(1)[0]
        return " ".join(words)

    made = [" ".join(base + own(110 + i % 4)) for i in range(60)]  # the shared text and a tail each: under the threshold
    made += [edited([3]), edited([196])]  # like one another, unlike all before
    made += [" ".join(base[:40] + own(1) + base[41:] + own(30)), " ".join(base[:100])]  # like the two before
    made += ["z " * 3 + edited([90]) + " " + " ".join(own(18))]
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_groups(table(spark, made)).collect()}
    want = brute_near(dict(enumerate(made)))
    assert want[60] == want[61] == 60 and len(set(want.values())) > 60
    assert got == want


def test_copies_inside_a_common_passage_are_found(spark):
    """A passage in very many texts of one length; some of their own parts are copies with edits."""
    rng = random.Random(14)
    word = lambda: f"o{rng.randrange(10**7)}"
    passage = [f"p{i}" for i in range(120)]
    made = []
    for k in range(150):
        own = [word() for _ in range(80)]
        made.append(" ".join(own[:40] + passage + own[40:]))
        if k % 10 == 0:
            for _ in range(2):
                own[rng.randrange(80)] = word()
                made.append(" ".join(own[:40] + passage + own[40:]))
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_groups(table(spark, made)).collect()}
    want = brute_near(dict(enumerate(made)))
    assert got == want and len(set(want.values())) == 150


def test_texts_of_one_class_are_not_compared_again(spark, monkeypatch):
    """Beginnings of one text with edits, many of them under the threshold to their heads: chains of likeness make them one class after few comparisons."""
    rng = random.Random(16)
    base, made = [f"b{i}" for i in range(120)], []
    for _ in range(300):
        words = list(base)
        for at in rng.sample(range(120), rng.choice((2, 3))):
            words[at] = f"o{rng.randrange(10**7)}"
        made.append(" ".join(words[: 120 - rng.randrange(60)]))
    checked, stored = [], order_minhash.staged

    def counted(df, name):
        out = stored(df, name)
        checked.extend([out.count()] if name == "op3-checked" else [])
        return out

    monkeypatch.setattr(order_minhash, "staged", counted)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_groups(table(spark, made)).collect()}
    assert got == brute_near(dict(enumerate(made)))
    # the first level is two tables; later ones are only for texts that are not of the class yet
    assert sum(checked[2:]) < 4 * len(made), checked


@pytest.mark.parametrize("few", (0, 2_048))
def test_classes_merge_level_after_level(spark, monkeypatch, few):
    rng = random.Random(17)
    monkeypatch.setattr(order_minhash, "FEW", few)
    classes, every = None, []
    for n in (60, 40, 1, 25):
        links = [(rng.randrange(200), rng.randrange(200)) for _ in range(n)]
        links = [(a, b) for a, b in links if a != b] or [(every[0][0], every[0][1])]
        every += links
        classes = order_minhash._merged(classes, spark.createDataFrame(links, "doc_id long, head long"), "test")
        got = [tuple(r) for r in classes.select("doc_id", "class_id").collect()]
        assert sorted(got) == sorted(order_minhash._roots(every)) and len(got) == len({x for e in every for x in e})
    assert [x for x, low in got if low != dict(got)[low]] == []


def test_near_recall_on_the_documents(spark):
    """All pairs at an edit similarity of 0.8 or more, by comparing every two texts; a text in blocks (``BLOCK``) gives the same keys."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r["doc_id"]: order_minhash._Text(r["text"] or "", order_minhash.KMER) for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_groups(docs).collect()}
    ids, found = sorted(rows), collections.Counter()
    for n, i in enumerate(ids):
        for j in ids[:n]:
            same = rows[i].likeness(rows[j], 0.8)
            if same and rows[i].text.split() != rows[j].text.split():
                found[same >= 0.9, got[i] == got[j]] += 1
    assert found[True, True] >= 0.95 * sum(found[True, x] for x in (True, False)) > 50
    assert sum(found[x, True] for x in (True, False)) >= 0.9 * found.total()


def test_sketches_in_blocks(monkeypatch):
    rng = random.Random(15)
    hashes, counts = shingles.shingle_hashes([" ".join(f"w{rng.randrange(300)}" for _ in range(1000))])
    labelled = order_minhash.label_occurrences(hashes, counts)
    whole = order_minhash.order_sketch(labelled)
    for block in (1, 2, 7, 300):
        monkeypatch.setattr(order_minhash, "BLOCK", block)
        assert (order_minhash.order_sketch(labelled) == whole).all()


def test_order_matters():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    turned = words[100:] + words[:100]
    assert order_minhash.similarity(" ".join(words), " ".join(turned)) == 0.0
    one = shingles.shingle_hashes([" ".join(words)])[0]
    other = shingles.shingle_hashes([" ".join(turned)])[0]
    keys = [order_minhash.order_sketch(order_minhash.label_occurrences(x, np.array([len(x)]))) for x in (one, other)]
    assert np.mean(keys[0] == keys[1]) < 0.7 and rng


# 4


def test_exact_groups_are_brute_force(docs, texts):
    import re

    key = [hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest() for t in texts]
    for counters in (2, 1024):
        got = {r["doc_id"]: r for r in exact_dedup.exact_groups(docs, counters).collect()}
        for i, k in enumerate(key):
            same = [j for j, x in enumerate(key) if x == k]
            assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"], got[i]["text_sha256"]) == (same[0], len(same), i == same[0], k)


def test_misra_gries_holds_the_frequent():
    rng = random.Random(6)
    values = [rng.choice("aaaabbbcdefghijklmnop") for _ in range(2000)]
    held = exact_dedup.misra_gries([(v, 1) for v in values], 8)
    assert len(held) <= 8 and {v for v, n in collections.Counter(values).items() if n > 2000 / 9} <= set(held)


# 5


def test_marginals_are_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    n_lines = np.array([1, 2, 7])
    emit, trans = rng.normal(size=(10, 2)), rng.normal(size=(2, 2))
    one, pairs = quality_crf.marginals(emit, trans, n_lines)
    at = 0
    for n in n_lines.tolist():
        total, m = 0.0, np.zeros((n, 2))
        for way in itertools.product((0, 1), repeat=n):
            w = math.exp(sum(emit[at + i, way[i]] for i in range(n)) + sum(trans[way[i - 1], way[i]] for i in range(1, n)))
            total += w
            for i in range(n):
                m[i, way[i]] += w
        assert np.allclose(m / total, one[at : at + n])
        at += n


def test_gradient_is_that_of_the_enumerated_likelihood():
    import itertools

    rng = np.random.default_rng(3)
    n_lines = np.array([1, 3, 5])
    x, y = rng.normal(size=(9, 4)), rng.integers(0, 2, 9)
    weights, trans = rng.normal(size=(4, 2)), rng.normal(size=(2, 2))

    def likelihood(weights, trans):
        total, at = 0.0, 0
        for n in n_lines.tolist():
            emit = x[at : at + n] @ weights
            score = lambda way: sum(emit[i, way[i]] for i in range(n)) + sum(trans[way[i - 1], way[i]] for i in range(1, n))  # noqa: B023, E731
            total += (score(y[at : at + n]) - math.log(sum(math.exp(score(way)) for way in itertools.product((0, 1), repeat=n)))) / n
            at += n
        return total / len(n_lines)

    grad_w, grad_t = quality_crf.gradient(x, y, n_lines, weights, trans)
    for value, grad in ((weights, grad_w), (trans, grad_t)):
        for place in np.ndindex(value.shape):
            step = np.zeros_like(value)
            step[place] = 1e-5
            up = likelihood(weights + step, trans) if value is weights else likelihood(weights, trans + step)
            down = likelihood(weights - step, trans) if value is weights else likelihood(weights, trans - step)
            assert abs((up - down) / 2e-5 - grad[place]) < 1e-7


def test_lines_of_the_other_kind_change_their_label():
    one = np.array([[0.95, 0.05], [0.02, 0.98], [0.02, 0.98], [0.99, 0.01], [0.5, 0.5]])
    size, n_lines = np.array([10, 100, 5, 90, 10]), np.array([2, 3])
    assert quality_crf.relabelled(one, np.array([1, 1, 0, 0, 0]), size, n_lines).tolist() == [0, 1, 1, 0, 0]
    assert quality_crf.relabelled(one, np.array([1, 1, 1, 1, 1]), size, n_lines).tolist() == [0, 1, 1, 1, 1]  # too much of the second text


def test_training_reads_whole_texts(spark):
    """What tells the kinds apart stands after the first lines only."""
    good, bad = "plain words stand here today.\n", "### $$$ %%% 12 34\n"
    made = [good * 300 + (good if i % 2 else bad) * 600 for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rows = quality_crf.score_documents(table(spark, made), quality_crf.train(table(spark, made), labels, train_lines=80)).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in rows)


def test_quality_on_held_out_rows(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    got = quality_crf.score_held_out(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 50 and np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95


def test_quality_edges(docs, texts, spark, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rows = quality_crf.score_held_out(docs, labels).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    none = quality_crf.score_held_out(docs, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    whole = quality_crf.LineField.fit(["good words here."] * 5 + ["### $$$ %%%"] * 5, np.array([1.0] * 5 + [0.0] * 5))
    assert whole.score(["good words here."])[0] > 0.5 > whole.score(["### $$$ %%%"])[0]
    assert quality_crf.score_held_out(empty, labels).count() == 0


# 6


def test_raked_weights_meet_targets(spark):
    rng = random.Random(2)
    made = [" ".join(["w"] * rng.randrange(1, 2000)) for _ in range(200)]
    docs = table(spark, made, lang=[rng.choice(["en", "fr", None]) for _ in made], source=[rng.choice(["a", "a", "a", "b", None]) for _ in made])
    targets = {"source": {"a": 0.2, "b": 0.3, "(none)": 0.5}, "lang": {"en": 0.5, "fr": 0.25, "(none)": 0.25}}
    cells = mixing.described(docs).groupBy(*mixing.DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    raked = mixing.rake(cells, targets, sweeps=60).toPandas()
    for d in ("source", "lang"):
        assert np.allclose(raked.groupby(d).weight.sum().reindex(targets[d]).to_numpy(), list(targets[d].values()), atol=1e-6)
    got = mixing.mix(docs, targets, keep_share=0.4).toPandas()
    assert len(got) == 200 and got.probability.between(0, 1).all()
    assert abs((got.probability * got.tokens).sum() / got.tokens.sum() - 0.4) < 0.02


def test_contradictory_targets_are_reported(spark):
    docs = table(spark, ["a b c", "d e f g h i"], lang=["en", "fr"], source=["a", "b"])
    with pytest.warns(UserWarning, match="contradict"):
        got = mixing.mix(docs)
    assert got.count() == 2
    cells = mixing.described(docs).groupBy(*mixing.DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    with pytest.warns(UserWarning, match="contradict"):
        left = mixing.gaps(mixing.rake(cells)).collect()
    assert max(abs(r["target"] - r["held"]) for r in left) > 0.001


def test_topics_come_from_the_column_that_is_named(spark):
    docs = table(spark, ["a b c", "d e f g h i"]).withColumn("topic", F.lit("given"))
    assert {r["topic"] for r in mixing.mix(docs).collect()} == {"notes"}
    assert {r["topic"] for r in mixing.mix(docs, topic_column="topic").collect()} == {"given"}


def brute_mixture(rows, keep_share=mixing.KEEP_SHARE, seed=6):
    """(doc_id, text, source, lang) of every row: the ids that stay, by plain loops."""
    import re

    described, cells = {}, collections.Counter()
    for i, text, source, lang in rows:
        text = text or ""
        tokens = len(re.findall(r"[^ \t\n\r\f]+", text))
        digits, lines = sum(c in "0123456789" for c in text), text.count("\n") + 1
        topic = "figures" if digits * 40 >= len(text) else "notes" if tokens < 120 else "listings" if tokens < lines * 30 else "articles" if tokens < 1000 else "works"
        described[i] = (source or "(none)", lang or "(none)", topic)
        cells[described[i]] += tokens
    weight = {c: float(t) for c, t in cells.items()}
    shares = []
    for k, power in enumerate((0.7, 0.6, 0.8)):
        raw = collections.Counter()
        for c, t in cells.items():
            raw[c[k]] += t
        raw = {v: t**power for v, t in raw.items()}
        shares.append({v: t / sum(raw.values()) for v, t in raw.items()})
    for _ in range(60):
        for k in range(3):
            held = collections.Counter()
            for c, w in weight.items():
                held[c[k]] += w
            weight = {c: w * shares[k][c[k]] / held[c[k]] if held[c[k]] else 0.0 for c, w in weight.items()}
    total, constant = sum(cells.values()), keep_share * sum(cells.values())
    ratio = {c: weight[c] / t if t else 0.0 for c, t in cells.items()}
    for _ in range(mixing.RAISES):
        full = {c for c in cells if ratio[c] * constant >= 1}
        rest = sum(w for c, w in weight.items() if c not in full)
        constant = max(constant, (keep_share * total - sum(cells[c] for c in full)) / rest) if rest else constant
    chance = {c: min(1.0, ratio[c] * constant) if t else 1.0 for c, t in cells.items()}
    return {i for i, c in described.items() if int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16) / 2**32 < chance[c]}


def test_mixing_has_no_python(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# 7


def check_packing(rows, want, capacity):
    pieces = collections.defaultdict(list)
    places = collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(want)
    for i, ids in want.items():
        data, at = np.array(ids, dtype="<u4"), 0
        for n, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, at) and r["ids_crc32"] == zlib.crc32(data[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and len(pieces[i]) == -(-len(ids) // capacity)
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


@pytest.mark.parametrize("how", [{}, {"leaf_pieces": 5, "fan_in": 2, "carry": 4}])
def test_packing(docs, texts, library, how):
    want = {i: [*ids_of(library, t), 0] for i, t in enumerate(texts)}
    capacity = 256
    used = check_packing(packing.pack_documents(docs, capacity=capacity, **how).collect(), want, capacity)
    assert used <= 1.1 * sum(map(len, want.values())) / capacity + 2


def test_best_fit_takes_the_tightest():
    bins = packing.BestFit(10)
    assert [bins.put(n) for n in (6, 7, 3, 4, 1)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0)]


# 8


def test_fingerprints(docs, texts):
    own = [t or "" for t in texts]
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(own, own[1:] + own[:1])]
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(docs).collect()}
    assert len(got) == len(own)

    def jaccard(a, b):
        x, y = ({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
        return len(x & y) / len(x | y)

    for i, (t, e, n) in enumerate(zip(own, edited, own[1:] + own[:1])):
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert abs(r["near_edited"] - jaccard(t, e)) < 0.2 and abs(r["near_next"] - jaccard(t, n)) < 0.2
    by_text = collections.defaultdict(set)
    for i, t in enumerate(own):
        by_text[t].add(got[i]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())


def test_similar_documents(spark, texts, empty):
    rng = random.Random(21)
    made = list(texts)
    for base in ([f"w{rng.randrange(400)}" for _ in range(200)], [f"v{rng.randrange(90)}" for _ in range(120)]):
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            made.append(" ".join(words))
    passage = [f"p{i}" for i in range(60)]
    for k in range(40):  # a passage in all, and a few copies of the rest
        own = [f"o{rng.randrange(10**7)}" for _ in range(140)]
        made.append(" ".join(own[:70] + passage + own[70:]))
        if k % 8 == 0:
            own[5] = "edited"
            made.append(" ".join(own[:70] + passage + own[70:]))
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in ((t or "").split() for t in made)]
    parent = list(range(len(made)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(made)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    got = {r["doc_id"]: r for r in fingerprint.similar_documents(table(spark, made)).collect()}
    assert {i: r["class_id"] for i, r in got.items()} == {i: find(i) for i in range(len(made))}
    assert fingerprint.similar_documents(empty).count() == 0


def test_fingerprints_in_blocks(monkeypatch, texts):
    some = [t or "" for t in texts]
    whole = fingerprint.signatures(some)
    for block in (3, 50):
        monkeypatch.setattr(fingerprint, "BLOCK", block)
        assert (fingerprint.signatures(some) == whole).all()


# 9


def test_shards(docs, texts):
    rows = sharding.shard_documents(docs, shards=4, slot_block=3).collect()
    sizes, slots, of_text = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        t = texts[r["doc_id"]] or ""
        assert (r["size"], r["text_crc32"], r["law"]) == (len(t.encode()) + 16, zlib.crc32(t.encode()), "bytes")
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        of_text[t].add(r["shard"])
    assert len(rows) == len(texts) and all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.05 * sum(sizes.values())


def test_large_groups_leave_no_shard_empty(spark):
    def loads(sizes, shards):
        out = [0] * shards
        for size, bin_ in zip(sizes, sharding.shards_for(sizes, shards)):
            out[bin_] += size
        return out

    third = loads([10_000, *[20] * 1_000], 40)
    assert third[0] == 10_000 and set(third[1:]) <= {500, 520}
    assert sorted(loads([500, *[10] * 950], 40))[-2] - min(loads([500, *[10] * 950], 40)) <= 10
    assert sorted(loads([7] * 41, 40)) == [7] * 39 + [14]
    assert loads([3, 2], 4) == [3, 2, 0, 0] and sharding.shards_for([], 4) == []
    # a group of equal texts with a third of the bytes
    many = ["x" * 84] * 100 + [f"text {i:05d} " + "y" * 72 for i in range(200)]
    rows = sharding.shard_documents(table(spark, many), shards=10).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 10 and len({r["shard"] for r in rows if r["doc_id"] < 100}) == 1
    rest = sorted(sizes.values())[:-1]
    assert rest[-1] - rest[0] <= 100


def test_best_fit_decreasing_is_the_plain_one():
    rng = random.Random(1)
    for _ in range(100):
        sizes = sorted((rng.randint(1, 50) for _ in range(rng.randint(0, 600))), reverse=True)
        room, want = [], []
        for s in sizes:
            fits = [(r, k) for k, r in enumerate(room) if r >= s]
            if fits:
                k = min(fits)[1]
            else:
                k = len(room)
                room.append(50)
            room[k] -= s
            want.append(k)
        got = sharding.best_fit_decreasing(sizes, 50)
        loads = lambda p: sorted(collections.Counter({}) + sum((collections.Counter({k: s}) for k, s in zip(p, sizes)), collections.Counter()))
        assert len(set(got)) == len(set(want)) and len(loads(got)) == len(loads(want))


# 10


def test_code_lengths_are_the_recursive_definition(monkeypatch):
    samples = {"a": [language_id.normal("abracadabra abra")], "b": [language_id.normal("banana bandana")]}
    trees = language_id.ByteTrees.learn(samples)
    counts = {x: collections.Counter() for x in samples}
    for x, some in samples.items():
        for t in some:
            for i in range(3, len(t)):
                for k in range(4):
                    counts[x][t[i - k : i + 1]] += 1
    known = {c[:-1] for x in samples for c in counts[x]}

    def probability(x, context, symbol):
        if context is None:
            return 1 / 256
        after = {bytes([s]): counts[x][context + bytes([s])] for s in range(256) if counts[x][context + bytes([s])]}
        shorter = context[1:] if context else None
        if context not in known or not after:
            return probability(x, shorter, symbol)
        whole = sum(after.values()) + len(after)
        if symbol in after:
            return after[symbol] / whole
        return len(after) / whole * probability(x, shorter, symbol) / (1 - sum(probability(x, shorter, s) for s in after))

    for text, block in (("abra banana", 262_144), ("zzz", 262_144), ("bandabra é", 262_144), ("abra banana bandabra", 3), ("banana", 1)):
        monkeypatch.setattr(language_id, "BLOCK", block)
        t = language_id.normal(text)
        want = [-sum(math.log2(probability(x, t[i - 3 : i], t[i : i + 1])) for i in range(3, len(t))) for x in ("a", "b")]
        assert np.allclose(trees.bits([t])[0], want, rtol=1e-4)


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)


def test_sample_is_the_first_by_hash(spark):
    rng = random.Random(13)
    texts = ["word " * 2_000 for _ in range(3)] + ["mot " * 9_000] + ["w " * rng.randint(1, 60) for _ in range(400)]
    lang = ["few"] * 3 + ["one"] + [("many", "more")[i % 2] for i in range(400)]
    made = table(spark, texts, lang=lang)
    order = {r["doc_id"]: r["o"] for r in made.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), F.lit(10)).alias("o")).collect()}
    want = {}
    for name in sorted(set(lang)):
        total, chosen = 0, []
        for i in sorted((i for i in order if lang[i] == name), key=order.get):
            if total < 500:
                chosen.append(i)
            total += len(texts[i])
        want[name] = [len(language_id.normal(texts[i])) if len(texts[i]) <= 500 else 503 for i in sorted(chosen)]
    found = language_id.training_sample(made, 500)
    assert {k: [len(x) if len(x) < 500 else 503 for x in v] for k, v in found.items()} == want and all(want.values())


def test_sample_of_a_long_text_is_from_all_over_it(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_BLOCK", 10)
    text = "".join(f"{i:09d}." for i in range(1000))
    (found,) = language_id.training_sample(table(spark, [text], lang=["x"]), 200)["x"]
    parts = found.decode().split()
    assert len(parts) == 20 and all(x in text for x in parts) and int(parts[-1][:9]) > 500


def test_letters_are_letters(spark):
    odd = ["½ ② ³", "Ⅷ ⅷ", "١٢٣", "__", "½ a", "ªº", "中", "12"]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(table(spark, odd), language_id.ByteTrees.learn({"en": [language_id.normal("some words")]})).collect()}
    assert [got[i] == "und" for i in range(len(odd))] == [not any(c.isalpha() for c in t) for t in odd] == [True] * 4 + [False] * 3 + [True]


def test_language_edges(spark, texts):
    docs = table(spark, texts, lang=["en" if i % 3 else None for i in range(len(texts))])
    got = {r["doc_id"]: r for r in language_id.identify_held_out(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert (got[i]["lang_pred"] == "und") == (not any(c.isalpha() for c in t or ""))
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    untaught = language_id.identify_held_out(table(spark, ["words", None])).collect()
    assert {r["lang_pred"] for r in untaught} == {"und"}


# all


def test_empty_tables(empty):
    assert token_count.token_counts(empty).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0
    assert order_minhash.near_groups(empty).count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert packing.pack_documents(empty).count() == 0
    assert fingerprint.fingerprints(empty).count() == 0
    assert sharding.shard_documents(empty).count() == 0
    assert language_id.identify_held_out(empty).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got, want = queries.queries()[name](spark, sf_dir).toPandas(), con.sql(queries.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    plain = lambda f: sorted(map(str, f[columns].itertuples(index=False, name=None)))
    assert plain(got) == plain(want)


def test_pipeline(spark, sf_dir, library):
    """Each stage's decisions, one after the other, on the small tables."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, held = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        rows = held.select("doc_id", "text", "source", "lang").collect()
        before = {r["doc_id"]: r["text"] for r in rows}
        out = stage(spark, held, sf_dir)
        if name == "best-fit packing":
            check_packing(out.collect(), {i: [*ids_of(library, t), 0] for i, t in before.items()}, packing.CAPACITY)
            break
        assert out.columns == columns
        held = corpus_pipeline.staged(out, "test")
        after = {r["doc_id"]: r["text"] for r in held.select("doc_id", "text").collect()}
        assert set(after) <= set(before)
        if name == "language ID":
            assert set(before) - set(after) == {i for i, t in before.items() if not any(c.isalpha() for c in t or "")}
        elif name == "line dedup":
            order = sorted(before)
            want = dict(zip(order, brute_lines([before[i] for i in order], line_dedup.BLOCK_WORDS, line_dedup.RARE)))
            assert {i: after.get(i, "") for i in order} == want
        elif name == "MinHash near-dedup":
            want = brute_near(before)
            assert set(after) == set(want.values())
        else:
            assert set(after) == brute_mixture([tuple(r) for r in rows])
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.count() == out.count()


def test_components_of_a_hot_head_and_of_a_chain(spark):
    from quorumtext.llm.order_minhash import HOT, components, _hot

    star = [(k, 0) for k in range(1, 4_000)]
    chain = [(k + 1, k) for k in range(10_000, 10_040)]
    both = [(9_000, 4), (9_000, 8_000), (8_001, 8_000)]
    links = spark.createDataFrame(star + chain + both, "doc_id long, head long")
    got = {r.doc_id: r.class_id for r in components(links, "test").collect()}
    want = {k: 0 for k in [*range(4_000), 8_000, 8_001, 9_000]} | {k: 10_000 for k in range(10_000, 10_041)}
    assert got == want
    # the head's rows are dealt to so many parts that none is larger than the least hot key's
    hot = _hot(links, "head").collect()
    assert [(r.head, r._salts) for r in hot if r._salts > 1] == [(0, -(-len(star) * HOT // links.count()))]
    assert len(hot) <= HOT and sum(r._salts for r in hot) <= 2 * HOT
