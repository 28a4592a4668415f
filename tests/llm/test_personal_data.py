"""Personal data: base rules by plain regular expressions, the tagger by enumeration."""
import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import personal_data as pii
from ledgerlake.llm import queries
from ledgerlake.llm.common import table
from ledgerlake.llm.tagger import Tagger, batch, spans_of, tags_of

SF = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn_holds(d):
    twice = [sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])]
    return sum(twice) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(d) <= 19 and luhn_holds(d)):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), list(PLAIN).index(kind), m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(table(spark, "/root/testdata/sf0.01", "documents"))


# --- base rules ------------------------------------------------------------------------

def test_base_rules_on_random_marks():
    rng = random.Random(4)
    for _ in range(30_000):
        text = "".join(rng.choice("a1.@-+ ()25%9:") for _ in range(rng.randrange(1, 26)))
        assert pii.base_spans(text) == plain_base(text), text


def test_base_rules_on_made_values():
    rng = random.Random(5)
    for _ in range(3000):
        text = " ".join(pii.planted(rng, rng.choice(pii.KINDS), pii.WORDS) + rng.choice(["", ",", "."])
                        for _ in range(3))
        assert pii.base_spans(text) == plain_base(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "1." * 200_000, "a" * 300_000 + "@", "+1" + "-" * 200_000,
                 "a@" * 200_000, "1 " * 200_000, "(at)" * 50_000):
        pii.base_matches(text)


# --- tagger ----------------------------------------------------------------------------

def small_tagger(seed=1):
    m = Tagger.fresh(2, 3, seed, np.float64)
    rng = np.random.default_rng(seed)
    for k in ("T", "first", "c"):
        m.p[k] = rng.normal(size=m.p[k].shape) * 2
    return m


def paths(m, text):
    """Every path of tags with its score."""
    e = m.scores(*batch([text]))[0]
    t, first = (a + b for a, b in zip(m.allowed(), (m.p["T"], m.p["first"])))
    for y in itertools.product(range(e.shape[1]), repeat=len(text)):
        yield y, (first[y[0]] + sum(e[i, k] for i, k in enumerate(y))
                  + sum(t[a, b] for a, b in zip(y, y[1:])))


def test_decoding_takes_the_best_path():
    for seed, text in enumerate(["a1@b", "1.2 ", "x", "()-3"]):
        m = small_tagger(seed)
        best = max(paths(m, text), key=lambda p: p[1])[0]
        got = m.decode([text, "longer one", ""])[0]
        assert [s[:3] for s in got] == spans_of(np.array(best))


def test_loss_is_the_likelihood_of_all_paths_and_its_gradient():
    m = small_tagger()
    texts, spans = ["a1@b", "x", "q.1"], [[(1, 0, 3)], [(0, 1, 1)], []]
    x, sizes = batch(texts)
    y = np.array([tags_of(s, x.shape[1]) for s in spans])
    want = 0.0
    for text, row in zip(texts, y):
        scores = dict(paths(m, text))
        want += np.logaddexp.reduce(list(scores.values())) - scores[tuple(row[:len(text)])]
    loss, g = m.loss_and_gradient(x, sizes, y)
    assert abs(loss - want / 3) < 1e-9
    for k, v in m.p.items():
        for at in list(np.ndindex(v.shape))[::max(1, v.size // 25)]:
            old = v[at]
            v[at] = old + 1e-5
            up = m.loss_and_gradient(x, sizes, y)[0]
            v[at] = old - 1e-5
            down = m.loss_and_gradient(x, sizes, y)[0]
            v[at] = old
            assert abs((up - down) / 2e-5 - g[k][at]) < 1e-7, k


def test_both_directions_reach_the_tags():
    m = small_tagger()
    a, b, c = (m.scores(*batch([t]))[0] for t in ("1a.b2", "9999999a.b2"[6:], "1a.b@"))
    assert np.allclose(a, b)
    assert not np.allclose(a[0], c[0]), "the first tag sees the last character"


def test_tags_and_spans_are_inverse():
    spans = [(0, 1, 2), (2, 1, 3), (5, 0, 9)]
    assert spans_of(tags_of(spans, 9)) == spans
    assert spans_of(tags_of([], 4)) == []


# --- training --------------------------------------------------------------------------

def held_out(spark, n=500):
    docs = [r["text"] for r in table(spark, "/root/testdata/sf0.1", "documents").filter(
        "doc_id % 20 = 3 AND text IS NOT NULL").orderBy("doc_id").limit(150).collect()]
    windows = [w for i, t in enumerate(docs) for w in pii.sample_windows(t, i)]
    texts, spans = pii.labelled(windows, n, seed=1234)
    return texts[-n:], spans[-n:]


def test_held_out_spans_are_found(spark, model):
    """Made windows of documents and values not trained on, raw decoding: F1 of the added kinds."""
    texts, spans = held_out(spark)
    hit, wrong, missed = Counter(), Counter(), Counter()
    for got, want in zip(model.decode(texts), spans):
        got, want = {s[:3] for s in got}, set(want)
        for name, some in ((hit, got & want), (wrong, got - want), (missed, want - got)):
            name.update(k for _, k, _ in some if k >= len(pii.BASE))
    total = 2 * sum(hit.values())
    assert total / (total + sum(wrong.values()) + sum(missed.values())) >= 0.85, (hit, wrong, missed)


def test_planted_values_are_found_in_documents(model):
    rng = random.Random(77)
    found = wanted = extra = 0
    for _ in range(300):
        kind = rng.choice(pii.ADDED)
        value = pii.planted(rng, kind, pii.WORDS)
        before = " ".join(rng.choice(pii.WORDS) for _ in range(rng.randrange(1, 60)))
        text = f"{before} {value} " + " ".join(rng.choice(pii.WORDS) for _ in range(20))
        _, base, added = next(pii.scan_texts([(1, text)], model))
        if base:
            continue  # an account number may pass as a card
        wanted += 1
        found += (len(before) + 1, pii.KINDS.index(kind), len(before) + 1 + len(value)) in added
        extra += len(added) > 1
    assert found / wanted >= 0.85 and extra / wanted <= 0.03


def test_clean_texts_get_no_spans(spark, model):
    rng = random.Random(9)
    rows = [(i, " ".join(pii.plain_number(rng) if rng.random() < 0.2 else rng.choice(pii.WORDS)
                         for _ in range(60))) for i in range(400)]
    added = [s for _, _, spans in pii.scan_texts(rows, model) for s in spans]
    assert len(added) <= 2  # of about 4800 numbers
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    texts = dict(docs)
    for doc_id, _, spans in pii.scan_texts(docs, model):
        for a, k, b in spans:
            assert pii.shaped(pii.KINDS[k], texts[doc_id][a:b])


def test_training_on_planted_forms_alone(spark):
    m = pii.fit(spark.createDataFrame([], "doc_id long, text string"), made=64)
    assert all(np.isfinite(v).all() for v in m.p.values())


# --- windows and reconciling -----------------------------------------------------------

def test_windows_cover_every_mark():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab 1" if rng.random() < 0.1 else "ab ") for _ in range(700))
        covered = set()
        for lo, hi in pii.stretches(text):
            ws = list(pii.windows_of(lo, hi))
            assert ws[0][0] == lo and ws[-1][1] == hi
            assert all(b - a <= pii.WINDOW for a, b in ws)
            assert all(y[0] <= x[1] - pii.WINDOW // 2 for x, y in zip(ws, ws[1:]))
            covered |= {i for a, b in ws for i in range(a, b)}
        for m in re.finditer("1", text):
            assert set(range(max(0, m.start() - pii.REACH), min(700, m.end() + pii.REACH))) <= covered


def test_reconciling_unites_cut_parts_and_prefers_the_best_total():
    ssn = pii.KINDS.index("ssn")
    text = "x 123-45-6789 y 111-22-3333 z"
    cut = [(2, ssn, 8, 3.0, False, True), (5, ssn, 13, 4.0, True, False)]
    assert pii.reconcile(cut, text, []) == [(2, ssn, 13)]
    assert pii.reconcile(cut[:1], text, []) == []
    phone = pii.KINDS.index("local_phone")
    two = [(2, ssn, 13, 2.0, False, False), (16, ssn, 27, 1.0, False, False),
           (16, phone, 27, 9.0, False, False)]
    assert pii.reconcile(two, text, []) == [(2, ssn, 13), (16, ssn, 27)], "the shape decides"
    assert pii.reconcile(two, text, [(4, 0, 6, True)]) == [(16, ssn, 27)], "base spans stay"
    assert pii.reconcile([(2, ssn, 13, -1.0, False, False)], text, []) == []


def test_batches_do_not_change_results(model):
    rng = random.Random(12)
    rows = []
    for i in range(40):
        parts = [rng.choice(pii.WORDS) if rng.random() < 0.7 else
                 pii.planted(rng, rng.choice(pii.KINDS), pii.WORDS) for _ in range(rng.randrange(80))]
        rows.append((i, " ".join(parts)))
    together = list(pii.scan_texts(rows, model))
    assert together == [x for r in rows for x in pii.scan_texts([r], model)]
    long = " ".join(t for _, t in rows * 6)
    assert len(list(pii.windows_of(0, len(long)))) > pii.BATCH
    (_, base, added), = pii.scan_texts([(1, long)], model)
    assert base == plain_base(long) and len(added) > 100


# --- the query -------------------------------------------------------------------------

def check(rows, texts):
    for r, text in zip(rows, texts):
        text = text or ""
        base = plain_base(text)
        name = lambda spans: ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert [r[f"n_{k}"] for k in pii.BASE] == [
            sum(s[1] == i for s in base) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(name(base).encode()).hexdigest()
        every = [(int(a), pii.KINDS.index(k), int(b))
                 for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert every == sorted(every) and [s for s in every if s[1] < 4] == base
        for a, k, b in every:
            if k >= 4:
                assert not any(a < y and x < b for x, _, y in base)
                assert re.search(r"[0-9@]|at", text[a:b]) and pii.shaped(pii.KINDS[k], text[a:b])


def test_query_on_a_whole_table(spark):
    docs = table(spark, SF, "documents").collect()
    got = sorted(queries.op11_personal_data(spark, SF).collect(), key=lambda r: r["doc_id"])
    assert len(got) == len(docs)
    docs.sort(key=lambda r: r["doc_id"])
    check(got, [r["text"] for r in docs])
    assert sum(r["n_email"] + r["n_ip"] + r["n_phone"] for r in got) > 0


def test_odd_rows(spark, model):
    texts = [None, "", "1", "@", "ß€😀 a@b.de 😀 123-45-6789 ", "x 10.0.0.1 " * 20_000,
             "4111 1111 1111 1111", "4111 1111 1111 1111", "\x00\n\t", "+1 (017) 555-7713"]
    rows = [(None if i == 2 else i // 2, t, "n") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_email string")
    got = pii.scan(df, model).collect()
    assert len(got) == len(rows)
    check(got, [t for _, t, _ in rows])
    assert got[5]["n_ip"] == 20_000 and got[6]["n_card"] == got[7]["n_card"] == 1
    assert pii.scan(df.filter("false"), model).count() == 0
