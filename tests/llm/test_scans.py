"""License join and decontamination against brute force."""

import math
import random
import re

import pytest

from trialframe.llm import decontam, license_join, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_licenses(text, threshold=license_join.THRESHOLD):
    words, base, starts = words_of(text), set(), []
    for phrase, label in license_join.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    labels, best = set(base), 0.0
    for label, wording in license_join.TEMPLATES:
        t, span = set(license_join.template_words(wording)), license_join.span_of(wording)
        for i in range(len(words)):
            held = t & set(words[i:i + span])
            if len(held) >= math.ceil(threshold * len(t) - 1e-9):
                labels.add(label)
                best = max(best, len(held) / len(t))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), 1.0 if starts else best)


def scanned(docs):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)
                   for r in license_join.scan_documents(docs).collect()), key=str)


def test_licenses_against_brute_force(spark):
    r = random.Random(5)
    pool = [w for _, t in license_join.TEMPLATES for w in license_join.template_words(t)] + ["x", "é", "4", "zero"]
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(r.randint(0, 4)):
            if r.random() < 0.5:        # a template with words dropped, moved and added
                w = license_join.template_words(r.choice(license_join.TEMPLATES)[1])
                w = [x for x in w if r.random() < 0.95] + r.choices(pool, k=r.randint(0, 3))
                r.shuffle(w) if r.random() < 0.3 else None
            else:
                w = r.choices(pool, k=r.randint(0, 12))
            lines.append(r.choice([" ", "  ", ", "]).join(x.upper() if r.random() < 0.3 else x for x in w))
        texts.append("\n".join(lines))
    texts += ["MIT\nlicense", "mitK license", "MIT-License mit license", "LİCENSE mit license", "GENERAL public\tLICENSE general"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert scanned(docs) == sorted(((i, *brute_licenses(t)) for i, t in enumerate(texts)), key=str)


def test_wrapped_notices_and_scattered_words(spark):
    import textwrap

    texts, want = [], []
    for label, wording in license_join.TEMPLATES:
        for width in (24, 50, 72):
            texts.append("# " + "\n# ".join(textwrap.wrap("Some code stands here. " + wording + ". Then more follows.", width)))
            want.append(label)
    texts += ["all " + "other words " * 3 + "rights " + "other words " * 3 + "reserved", "reserved rights all"]
    want += ["", "reserved"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels.split(",") for r in license_join.scan_documents(docs).collect()}
    assert all(w in got[i] for i, w in enumerate(want))
    assert license_join.scan_blocks(docs).where("containment < 0.9").count() == 0


def test_licenses_on_edges(spark, edge_docs, no_docs):
    assert scanned(edge_docs) == sorted(((r.doc_id, *brute_licenses(r.text)) for r in edge_docs.collect()), key=str)
    assert scanned(no_docs) == []


def test_license_plan_is_native(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    plan = license_join.scan_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def items_and_texts(seed=7):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    items = [" ".join(r.choices(vocabulary, weights, k=r.randint(8, 150))) + (". And so w1 w2." if i % 2 else "") for i in range(40)]
    texts = []
    for i in range(60):
        w = r.choices(vocabulary, weights, k=r.randint(0, 500))
        if i % 3 == 0:
            held = decontam.words_of(r.choice(items))
            if i % 2:
                held = [x if r.random() < 0.9 else "other" for x in held]
            at = r.randint(0, len(w))
            w[at:at] = held
        texts.append(" ".join(w))
    return items, texts


@pytest.mark.parametrize("threshold", [0.3, 0.6])
def test_wand_finds_what_full_scoring_finds(threshold, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", 3)
    items, texts = items_and_texts()
    units = [set(u) for t in items for u in decontam.units_of(t)]
    df = {w: sum(w in u for u in units) for u in units for w in u}
    mean = sum(len(u) for t in items for u in decontam.units_of(t)) / len(units)
    index = decontam.Index(list(enumerate(items)), df, len(units), mean)
    terms = list(index.term)
    found = 0
    for text in texts:
        words = decontam.words_of(text)
        want = {}
        for k in range(0, max(1, len(words)), decontam.PASSAGE // 2):
            held = {index.term[w] for w in words[k:k + decontam.PASSAGE] if w in index.term}
            scores = {}
            for t in held:
                for u, x in zip(index.units[t], index.impacts[t], strict=True):
                    scores[u] = scores.get(u, 0.0) + x
            for u, s in scores.items():
                if s >= threshold - 1e-9:
                    item = index.owner[u]
                    if s > want.get(item, (0, 0))[0]:
                        want[item] = (s, k)
        got = index.retrieve(words, threshold)
        assert {i: round(s, 9) for i, (s, _) in got.items()} == {i: round(s, 9) for i, (s, _) in want.items()}
        found += len(got)
    assert found and len(terms) > 100


def test_leaks_are_found_and_clean_texts_left(spark):
    items, texts = items_and_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()}
    whole = {(d, i) for d, t in enumerate(texts) for i, item in enumerate(items)
             if " ".join(decontam.words_of(item)) in " ".join(decontam.words_of(t))}
    assert whole and whole <= got
    assert all(d % 3 == 0 for d, _ in got)


def test_chunks_of_items_change_nothing(spark, monkeypatch):
    items, texts = items_and_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    one = sorted(map(tuple, decontam.find_leaks(docs, bench).collect()))
    monkeypatch.setattr(decontam, "CHUNK_CHARS", 4_000)
    monkeypatch.setattr(decontam, "INDEX_UNITS", 5)
    assert sorted(map(tuple, decontam.find_leaks(docs, bench).collect())) == one


def test_decontamination_on_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(None, None, 1), (1, "", 1), (2, "Seven wizards box with five liquid jugs and many more words.", 1),
                                   (2, "Seven wizards box with five liquid jugs and many more words.", 1), (3, "one", 1)],
                                  "item_id long, text string, score int")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(edge_docs, bench).collect()}
    assert got == {(None, 2), (3, 2), (4, 2), (5, 2), (7, 3)}
    left = decontam.drop_leaks(edge_docs, bench)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 6, 8] and left.columns == edge_docs.columns
    assert decontam.find_leaks(no_docs, bench).count() == 0
    assert decontam.drop_leaks(edge_docs, bench.where("false")).count() == edge_docs.count()


def test_op3_finds_every_whole_item(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in queries.op3_decontaminate(spark, sf_small).collect()}
    assert {(d.doc_id, i.item_id) for d in docs for i in items if i.text in (d.text or "")} <= got


def near_copies(words):
    """Copies with a word replaced, dropped or inserted at each place, and with the first or last word cut."""
    for k in range(len(words)):
        yield [*words[:k], "changed", *words[k + 1:]]
        yield [*words[:k], *words[k + 1:]]
        yield [*words[:k], "changed", *words[k:]]


@pytest.mark.parametrize("sizes", [(4,), (7,), (9,), (12,), (6, 1), (9, 2), (8, 5), (10, 10), (30, 11), (70, 6)])
def test_near_copies_of_items_are_leaks(sizes):
    n = sum(sizes)
    words = [f"w{i}" for i in range(n)]
    cuts = [sum(sizes[:k]) for k in range(len(sizes) + 1)]
    text = " ".join(" ".join(words[a:b]) + "." for a, b in zip(cuts, cuts[1:], strict=False))
    others = [" ".join(f"x{i}" for i in range(k, k + 30)) for k in range(5)]
    items = list(enumerate([text, *others]))
    units = [u for _, t in items for u in decontam.units_of(t)]
    df = {w: sum(w in u for u in units) for u in units for w in u}
    index = decontam.Index(items, df, len(units), sum(map(len, units)) / len(units))
    around = [f"y{i}" for i in range(150)]

    def leaked(copy):
        held = [*around[:90], *copy, *around[90:]]
        found = index.retrieve(held, decontam.THRESHOLD)
        return 0 in found and index.verify(0, held, decontam.grams(held, decontam.GRAM), set(held))[-1]

    assert leaked(words)
    assert all(leaked(copy) for copy in near_copies(words))
    if len(sizes) > 1 and sizes[0] >= decontam.SHORT:
        assert leaked(words[:sizes[0]])                     # the question without its last sentence
        assert all(leaked(copy) for copy in near_copies(words[:sizes[0]]))
    assert not leaked(words[: n // 3]) and not leaked([])
    assert not leaked([x for w in words for x in (w, "between", "them", "all")][: 4 * 30])


def test_rare_words_may_be_edited():
    """Items that share common words and differ in a rare one: the heaviest words of a copy may be the changed ones."""
    r = random.Random(2)
    common = [f"c{i}" for i in range(12)]
    items = [" ".join([*r.sample(common, 7), *(f"rare{k}x{j}" for j in range(3))]) for k in range(200)]
    items += ["the big house zebra", *(f"the big house {w}" for w in ("lamp", "tree", "road"))]
    units = [u for t in items for u in decontam.units_of(t)]
    df = {w: sum(w in u for u in units) for u in map(set, units) for w in u}
    index = decontam.Index(list(enumerate(items)), df, len(units), sum(map(len, units)) / len(units))
    missed = 0
    for k in range(200):
        words = [w if not w.startswith("rare") else "changed" for w in items[k].split()]
        assert index.verify(k, words, decontam.grams(words, decontam.GRAM), set(words))[-1]
        missed += k not in index.retrieve(words, decontam.THRESHOLD)
    assert not missed and 200 in index.retrieve("the big house lion".split(), decontam.THRESHOLD)


def test_edits_against_tables():
    r = random.Random(4)
    for _ in range(300):
        item, words = (r.choices("abcd", k=r.randint(lo, 9)) for lo in (1, 0))
        row = [0] * (len(words) + 1)                        # an item may begin anywhere
        for k, a in enumerate(item):
            last, row = row, [k + 1]
            for j, b in enumerate(words):
                row.append(min(last[j] + (a != b), last[j + 1] + 1, row[j] + 1))
        assert decontam.edits(item, words) == min(row)
