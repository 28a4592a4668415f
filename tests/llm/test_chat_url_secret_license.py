"""Chat formatting, URL filter, secret scan and license scan against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np

from ledgerlake.llm import automaton, chat_format, license_scan, queries, secret_scan, url_filter
from ledgerlake.llm.common import table

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- chat ------------------------------------------------------------------------------

def brute_chat(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss),
                     sha(loss))
    return out


def test_chat_whole_table(spark):
    rows = rows_of(table(spark, SF, "conversations").select("conv_id", "turn", "role", "text"))
    said = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.op2_chat_format(spark, SF).collect()}
    assert got == brute_chat(rows)


def test_chat_edges(spark):
    bits = ["<|im_end|>", "<|im_start|>assistant\n", "<|im_sep|>", "&lt;|", "&amp;", "<", "|", "\n",
            "é", "𝄞", "", "<<|", "&#10;", "end<", "\\E"]
    rng = random.Random(1)
    rows = []
    for conv in range(30):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([turn, turn, None]),
                         rng.choice(["user", "assistant", "system", None, "a\nb", "<|x", "&"]),
                         rng.choice([None, "".join(rng.choices(bits, k=rng.randrange(6)))])))
    rows += [(None, 1, "user", "x"), (99, 1, "assistant", "long " * 50000)] + [(98, 1, "user", "t")] * 3
    df = spark.createDataFrame([(*r, "c", "c") for r in rows],
                               "conv_id long, turn long, role string, text string, "
                               "turns string, messages string")
    f = chat_format.format_conversations(df)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat_format.digest(f).collect()}
    assert got == brute_chat(rows)
    for r in f.collect():
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        roles = [m["role"] for m in r["messages"]]
        assert all(a != b for a, b in zip(roles, roles[1:]))
    assert chat_format.digest(chat_format.format_conversations(df.limit(0))).count() == 0


# --- URLs ------------------------------------------------------------------------------

def brute_url(url, model):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for verdict, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, verdict)
    if best is None:
        best = (None, "block" if url_filter.probability(host, path, model) >= 0.5 else "allow")
    return host, path, *best


def test_urls_whole_table_and_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "a://b://c/d",
            "https://example.com", "https://x.example.com/en/1", "https://notexample.com/en/",
            "https://www.example.com/en/", "http://a.net/es/?q", "http://net/fr/", "x://ÄB.net/fr",
            "http://cheap-pills.example.org/buy", "http://thanre.example.org/en/4", "q://h?x=/y",
            "http://multi.example.org/a\nb", "http://" + "a" * 100000 + ".org/", "s://h#/en/"]
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] * 2,
                               "page_id long, url string, host string, rule string")
    model = url_filter.trained()
    want = Counter((i, *brute_url(u, model)) for i, u in enumerate(urls) for _ in range(2))
    assert Counter(tuple(r)[:5] for r in url_filter.judge(df).collect()) == want
    pages = rows_of(table(spark, SF, "pages").select("page_id", "url"))
    got = {r["page_id"]: tuple(r)[1:5] for r in queries.op7_url_filter(spark, SF).collect()}
    assert got == {i: brute_url(u, model) for i, u in pages}
    assert url_filter.judge(df.limit(0)).count() == 0


def test_url_model_on_hosts_outside_the_table():
    model = url_filter.trained()
    bad = ["cheap-loans.example.org", "poker-bonus.example.com", "www.spam-pills.example.net",
           "casino-win.example.org"]
    good = ["ththand.example.org", "blog.tionsh.example.org", "m.thoner.example.org",
            "city-museum.example.org"]
    assert [url_filter.probability(h, "/en/7", model) >= 0.5 for h in bad + good] == [True] * 4 + [
        False] * 4
    assert len(url_filter.labelled_urls()) < 600


def test_url_labels_are_not_taken_from_the_pages(spark):
    words = {w for h, _, y in url_filter.labelled_urls() if not y for w in re.split("[.-]", h)}
    assert not words & {"ththth", "thther", "ththon"} and not hasattr(url_filter, "SYLLABLES")
    assert not {"bets", "ads", "track"} & set(url_filter.BLOCK_WORDS)
    model = url_filter.trained()
    bad = ["cheap-casinos.example.org", "onlinepharmacy.example.com", "xxx-porno.example.org",
           "pokerstakes.example.net", "fastpaydayloan.example.org"]
    good = ["bookshop.example.org", "wood-carving.example.com", "peterson.example.net",
            "botanical-society.example.org", "astronomy.example.com"]
    assert not {h.split(".")[0] for h in bad + good} & words
    assert [url_filter.probability(h, "/en/7", model) >= 0.5 for h in bad + good] == [True] * 5 + [
        False] * 5


def test_url_paths_are_judged_by_their_own_words():
    model = url_filter.trained()
    host = "hello.example.org"
    bad = ["/casino/bonus", "/porn/video1", "/casino-win/page", "/torrents/2", "/viagra/buy"]
    good = ["/en/7", "/news/today", "/articles/today", "/privacy.html", "/docs/adult-education"]
    assert [url_filter.probability(host, p, model) >= 0.5 for p in bad + good] == [True] * 5 + [
        False] * 5
    neutral = {(p, y) for h, p, y in url_filter.labelled_urls() if p in url_filter.PATHS}
    assert neutral == {(p, y) for p in url_filter.PATHS for y in (0, 1)}


def test_url_model_on_unseen_compounds():
    """Shares of allowed and blocked URLs judged right: known words in new surroundings."""
    model = url_filter.trained()

    def shares(urls):
        right = [[(url_filter.probability(h, p, model) >= 0.5) == y for h, p, y in urls if y == k]
                 for k in (False, True)]
        return [sum(x) / len(x) for x in right]

    paths = [(f"{h}.example.org", f"/{a}-{w}/{n}", y)
             for ws, y in ((url_filter.BLOCK_PATHS, True), (url_filter.ALLOW_PATHS, False))
             for n, w in enumerate(ws) for h in ("green", "delta", "owl")
             for a in ("my", "best", "the")]
    hosts = [(f"{a}{w}.{t}", p, y)
             for ws, y in ((url_filter.BLOCK_WORDS, True), (url_filter.ALLOW_WORDS, False))
             for w in ws for a, t in (("my", "org"), ("top-", "net"), ("get", "co.uk"))
             for p in ("/", "/de/5.html")]
    allowed, blocked = shares(paths)
    assert allowed >= 0.97 and blocked >= 0.7
    assert min(shares(hosts)) >= 0.97


# --- secrets ---------------------------------------------------------------------------

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|"""
                    r"""[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
                    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    found.sort()
    return found


def base_of(scanner, text):
    return [f for f in scanner.spans(text or "") if f[1] < 3]


def test_secrets_whole_table(spark):
    docs = rows_of(table(spark, SF2, "documents").select("doc_id", "text"))
    got = {r["doc_id"]: r for r in queries.op9_secret_scan(spark, SF2).collect()}
    n = 0
    for d, text in docs:
        want = brute_secrets(text)
        n += len(want)
        named = ",".join(f"{secret_scan.BASE[k]}:{a}:{b}" for a, k, b in want)
        r = got[d]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(
            sum(k == i for _, k, _ in want) for i in range(3))
        assert r["base_sha256"] == sha(named)
        assert set(filter(None, named.split(","))) <= set(r["spans"].split(","))
    assert n > 3


def test_secrets_random_strings_and_edges(spark):
    s = secret_scan.Scanner().ready()
    rng = random.Random(6)
    bits = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'",
            "abcdef", "abc", "AKIA", "A" * 16, "0123456789abcdef", "deadbeef" * 3, "é", "ſecret",
            "\n", "-", ".", "/", "toKen", "x"]
    for _ in range(4000):
        t = "".join(rng.choices(bits, k=rng.randrange(1, 14)))
        assert base_of(s, t) == brute_secrets(t), t
    extra = "ghp_" + "a1B2" * 8 + " -----BEGIN RSA PRIVATE KEY----- xoxb-123456789012"
    assert [s.kinds[k] for _, k, _ in s.spans(extra)] == ["github", "pem", "slack"]
    rows = [(1, None), (2, ""), (None, "token = abcdefgh"), (3, "é " * 50000 + "f" * 24),
            (3, "é " * 50000 + "f" * 24)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_hex int")
    got = Counter((r["doc_id"], r["spans"]) for r in secret_scan.scan(df).collect())
    assert got == Counter({(1, ""): 1, (2, ""): 1, (None, "assign:0:16"): 1,
                           (3, "hex:100000:100024"): 2})
    assert secret_scan.scan(df.limit(0)).count() == 0


def test_automaton_is_minimal_and_agrees_with_re():
    patterns = [r"a(b|c)*d", r"[a-c]{2,3}", r"(?i:ab)+c?", r"x{2}y*"]
    rng = random.Random(2)
    for p in patterns:
        rows, ends = automaton.compile_rules([automaton.parse(p)], anywhere=False)
        start = automaton.linked(rows, ends)
        for _ in range(500):
            t = "".join(rng.choices("abcdxyAB", k=rng.randrange(7)))
            row = start
            for b in t.encode():
                row = row and row[b]
            assert bool(row and row[automaton.ACCEPT]) == bool(re.fullmatch(p, t)), (p, t)
    both = automaton.compile_rules([automaton.parse("ab|cb"), automaton.parse("ab|cb")], False)
    assert len(both[0]) == 3  # start, after a or c, end


# --- licenses --------------------------------------------------------------------------

def brute_licenses(text, templates=license_scan.TEMPLATES):
    """Names whose shingles are held to 80 % by some stretch of the template's own length."""
    def words(t):
        return re.findall(r"[^\W_]+", (t or "").lower())

    w = words(text)
    have = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    out = set()
    for name, _, t in templates:
        x = words(t)
        want = {tuple(x[i:i + 3]) for i in range(len(x) - 2)}
        n = len(x) - 2
        for i, s in enumerate(have):
            if s in want and len(want & set(have[max(0, i):i + n])) >= 0.8 * len(want):
                out.add(name)
                break
    return ",".join(sorted(out))


def test_licenses_whole_table(spark):
    docs = rows_of(table(spark, SF2, "documents").select("doc_id", "text"))
    got = {r["doc_id"]: r["licenses"]
           for r in queries.op1_license_scan(spark, SF2).collect()}
    assert got == {d: brute_licenses(t) for d, t in docs}
    assert len(set(got.values())) > 4


def test_licenses_every_template_in_noise_and_edges(spark):
    rng = random.Random(7)
    noise = [f"n{i}" for i in range(500)]
    rows, want = [], {}
    for i, (name, _, t) in enumerate(license_scan.TEMPLATES * 8):
        before, after = (rng.choices(noise, k=rng.randrange(60)) for _ in range(2))
        rows.append((i, " ".join([*before, t, *after])))
        want[i] = name
    rows += [(900, None), (901, ""), (902, "rights reserved"), (903, "ALL  rights\nRESERVED"),
             (904, " ".join(noise * 100) + " All rights reserved."), (None, "Licensed under CC BY-NC 4.0."),
             (903, "ALL  rights\nRESERVED"),
             (905, license_scan.TEMPLATES[1][2].replace("copy of this", "thing"))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kind string")
    out = license_scan.scan(df).collect()
    assert Counter((r["doc_id"], r["licenses"]) for r in out) == Counter(
        (d, brute_licenses(t)) for d, t in rows)
    for r in out:
        if r["doc_id"] in want:
            assert want[r["doc_id"]] in r["licenses"].split(",")
    one = next(r for r in out if r["doc_id"] == 903)
    assert one["spans"] == "0:20:proprietary" and one["kind"] == "proprietary"
    assert license_scan.scan(df.limit(0)).count() == 0


def test_licenses_retrieval_of_many_templates():
    rng = np.random.default_rng(3)
    word = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(word, n))
    templates = [(f"t{i}", "permissive", text(4 + i % 60)) for i in range(1000)]
    index = license_scan.Index(templates)
    held = [3, 77, 412, 500, 998]
    noise = " ".join(f"{text(50)} {templates[t][2]}" for t in held) + " " + text(50)
    s = license_scan.shingles(noise, license_scan.LowerHash())
    found = index.verify(s, index.retrieve(s))
    assert {t for t, *_ in found} == set(held)
    assert all(share == 1.0 for *_, share in found)
