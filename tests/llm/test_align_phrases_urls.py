"""Cross-tokenizer alignment, phrase collocations and URL filters against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.llm import bitmap, collocations, cross_tokenizer, url_filter

P = pytest.importorskip("public_tokenizers")
FILES = (P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
r = random.Random(11)
WORDS = ["".join(r.choice("aeiounrstl") for _ in range(r.randint(2, 8))) for _ in range(300)]


def prose(n, joint=" "):
    return joint.join(r.choice(WORDS) for _ in range(n))


TEXTS = [
    None, "", " ", "  ", "a", " a ", "a  b   c", "\ttab\nline\r\n end ", "x" * 700, "<|endoftext|> </s> <unk> <s>", "has ▁ inside " + prose(300), "ünï 日本語テキスト 😀 é İ J̌.", "日本語" * 200,
    prose(400), prose(50, "  "), prose(30) + "  " + prose(30) + "  " + prose(5), "a" + " b" * 200, "it's they'll 12,345.67 don't", prose(200, "\n"), prose(400), "\x00 \x01 \x1f x \x85 y", " " * 300 + "z", "z" + " " * 300,
]


# --- alignment ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def expected():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(FILES[0]), SentencePieceProcessor(model_file=FILES[1])
    a.encode_special_tokens = True
    letters = {}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    for k in plain:
        letters[chr(k)] = k
    for n, k in enumerate(x for x in range(256) if x not in plain):
        letters[chr(256 + n)] = k
    a_bytes = lambda k: bytes(letters[c] for c in a.id_to_token(k))

    def b_bytes(k):
        p = b.id_to_piece(k)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()

    def spans(ids, of):
        at, out = 0, []
        for k in ids:
            out.append((k, at, at + len(of(k))))
            at = out[-1][2]
        return out

    rows, counts = [], Counter()
    for t in TEXTS:
        raw = (" " + t).encode() if t else b""
        sa, sb = (spans(a.encode(" " + t, add_special_tokens=False).ids, a_bytes), spans(b.encode(t), b_bytes)) if t else ([], [])
        if b"".join(a_bytes(k) for k, *_ in sa) != raw or b"".join(b_bytes(k) for k, *_ in sb) != raw:
            sa, sb = [], []
        links = [(x[0], y[0]) for x in sa for y in sb if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in sa} & {y[2] for y in sb})
        groups, low = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(k) for k, s, e in spans_ if low < e <= c) for spans_ in (sa, sb)))
            low = c
        rows.append((len(sa), len(sb), len(groups), links, ";".join(groups)))
        counts.update(links)
    top = defaultdict(int)
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return {k: (na, nb, ng, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if g else "") for k, (na, nb, ng, links, g) in enumerate(rows)}


@pytest.mark.parametrize(("chunk", "hot"), [(1 << 16, 1 << 20), (16, 1 << 20), (40, 200), (1 << 16, 0)])
def test_alignment(spark, expected, chunk, hot):
    docs = spark.createDataFrame([(k, t, "clash", 1) for k, t in enumerate(TEXTS)], "doc_id long, text string, row string, pos int").repartition(3)
    got = cross_tokenizer.align(docs, *FILES, chunk=chunk, hot=hot)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = {x[0]: tuple(x)[1:] for x in got.collect()}
    assert rows == expected
    assert rows[10] == (0, 0, 0, 0, 0, 0, "")
    assert rows[13][0] > 400


def test_alignment_of_strange_rows(spark):
    docs = spark.createDataFrame([(None, "one two"), (None, "one two"), (3, None), (3, "one two")], "doc_id long, text string")
    rows = sorted((tuple(x) for x in cross_tokenizer.align(docs, *FILES, chunk=4).collect()), key=repr)
    assert [x[0] for x in rows] == [3, 3, None, None]
    assert sorted(x[1] > 0 for x in rows) == [False, True, True, True]
    assert cross_tokenizer.align(docs.where("doc_id = 7"), *FILES).count() == 0


def test_the_faster_library_gives_the_same_ids():
    """On every token by itself, pairs of tokens, and random Latin strings."""
    a = cross_tokenizer.Aligner(*FILES)
    assert a.fast
    tokens = [t.decode() for t in a.a_bytes[:-1] if cross_tokenizer.LATIN(t.decode("utf-8", "replace"))]
    assert len(tokens) > 49_000
    letters = [chr(k) for k in range(1, 0x250)]
    texts = tokens + [r.choice(tokens) + r.choice(tokens) for _ in range(20_000)] + ["".join(r.choice(letters) for _ in range(r.randint(1, 12))) for _ in range(5000)] + ["".join(r.choice("aeinrst'.,0 1\n") for _ in range(20)) for _ in range(5000)]
    assert [e.ids for e in a.a.encode_batch_fast(texts, add_special_tokens=False)] == [a.fast.encode_ordinary(t) for t in texts]


def test_fragments_compose_in_any_order():
    """The monoid's law: however the fragments of a text are bracketed, the same parts close."""
    for _ in range(200):
        text = "".join(r.choice("ab \n") for _ in range(r.randint(1, 60)))
        width = r.randint(1, 9)
        chunks = [text[k : k + width] for k in range(0, len(text), width)]
        outcomes = set()
        for _ in range(3):
            made = [cross_tokenizer.fragment(k, c) for k, c in enumerate(chunks)]
            parts = {2 * k: closed for k, (_, closed) in enumerate(made) if closed is not None}
            level = [f for f, _ in made]
            while len(level) > 1:
                k = r.randrange(len(level) - 1)
                level[k : k + 2], seam = [None], cross_tokenizer.compose(level[k], level[k + 1])
                level[k] = seam[0]
                if seam[1]:
                    parts[2 * seam[1][0] - 1] = seam[1][1]
            cut, prefix, suffix = level[0]
            whole = [prefix] if cut < 0 else [prefix, *(parts[k] for k in sorted(parts)), suffix]
            assert " ".join(whole) == text
            outcomes.add(tuple(whole))
        assert len(outcomes) == 1
        units = [u for part in outcomes.pop() for u in cross_tokenizer.CUT.split(part)]
        assert units == cross_tokenizer.CUT.split(text)


# --- collocations ---------------------------------------------------------------------------------


def brute_phrases(rows, least, most):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\v\f\r]", low):
            w = re.findall(r"[^ \t]+", piece)
            total[lang] += len(w)
            for n in range(1, 6):
                counts[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inner = {p[i : i + n] for p, a in cands.items() for n in range(2, len(p)) for i in range(len(p) - n + 1) if a >= f[p[i : i + n]]}
        rows_ = []
        for p, a in cands.items():
            if p not in inner:
                score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((score, a, " ".join(p), f[p[:k]], f[p[k:]]))
        rows_.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, left, right, total[lang], score) for i, (score, a, p, left, right) in enumerate(rows_[:most])]
    return sorted(out)


def phrase_rows():
    rows = [(None, "en"), ("", "fr"), (" \t ", None), ("One two three. one TWO three four; a b", None), ("x" * 3000, "en"), ("é " * 50, "fr"), ("ÀB àb c", "fr")]
    common = [prose(r.randint(2, 7)) for _ in range(25)]
    for _ in range(160):
        text = "".join(r.choice([prose(r.randint(1, 4)), r.choice(common)]) + r.choice([" ", "  ", ", ", ".\n", "\t", "!"]) for _ in range(r.randint(1, 30)))
        rows.append((text, r.choice(["en", "fr", None, "und"])))
    return rows + [rows[20]] * 9


@pytest.mark.parametrize("bits", [64, 9])
def test_collocations(spark, bits):
    """With fingerprints of nine bits nearly all are shared."""
    rows = phrase_rows()
    docs = spark.createDataFrame([(k, t, lang, "clash") for k, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, n string").repartition(3)
    got = collocations.collocations(docs, least=6, most=40, bits=bits)
    want = brute_phrases(rows, 6, 40)
    assert len(want) > 60
    found = got.collect()
    assert sorted(tuple(x)[:8] for x in found) == want
    for x in found:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), rows[x.doc_id][0])
        assert (rows[x.doc_id][1] or "und", re.findall(r"[^ \t.,;:!?\n\v\f\r]+", low)[x.word : x.word + len(x.phrase.split(" "))]) == (x.lang, x.phrase.split(" "))
    assert collocations.collocations(docs.where("doc_id < 0")).count() == 0


def test_blocks_and_colliding_fingerprints(monkeypatch):
    """Blocks of a long text lose no n-gram; a fingerprint that many texts share still gives exact counts."""
    import pyarrow as pa

    text = phrase_rows()[30][0] + " " + prose(400) + ". " + prose(400)
    want = brute_phrases([(text, "en")], 1, 10**6)
    monkeypatch.setattr(collocations, "RUN", 200)
    flat = np.frombuffer(text.encode(), np.uint8)
    seen = Counter()
    for run in collocations.word_runs(flat, np.array([0, len(flat)])):
        p = collocations.Prints(run, np.zeros(1, np.uint64))
        for n in range(2, 6):
            seen.update(p.packed[p.begin[k] : p.end[k + n - 1]].tobytes().decode() for k in p.whole(n).tolist())
    assert set(x[2] for x in want) <= set(seen)
    assert {x[2]: x[3] for x in want} == {k: v for k, v in seen.items() if k in {x[2] for x in want}}
    weak = collocations.Prints.of
    monkeypatch.setattr(collocations.Prints, "of", lambda self, first, n: weak(self, first, n) & np.uint64(3))

    batch = pa.RecordBatch.from_pylist([{"text": text, "lang": "en", "doc_id": 1}], schema=pa.schema([("text", pa.string()), ("lang", pa.string()), ("doc_id", pa.int64())]))
    caught = {}

    class Docs:
        def mapInArrow(self, run, schema):
            caught["rows"] = [x for out in run(iter([batch])) for x in out.to_pylist()]
            raise StopIteration

    class Everything:
        value = np.full(4, 2**64 - 1, np.uint64)

    with pytest.raises(StopIteration):
        collocations.exact_counts(Docs(), Everything(), Everything(), 1)
    sums = Counter()
    for x in caught["rows"]:
        sums[x["phrase"]] += x["n"]
    assert {k: v for k, v in sums.items() if len(k.split(" ")) > 1} == dict(seen)


def test_bit_map_hides_no_key(spark):
    keys = np.random.default_rng(1).integers(0, 2**63, 5000)
    df = spark.createDataFrame([(int(k),) for k in keys], "key long")
    for most in (1 << 27, 1 << 10):
        sent = bitmap.broadcast_bits(df, 5000, most)
        assert bitmap.holds(sent.value, keys.view(np.uint64)).all()
        assert len(sent.value) * 64 <= most
    others = np.random.default_rng(2).integers(0, 2**63, 5000).view(np.uint64)
    assert bitmap.holds(bitmap.broadcast_bits(df, 5000).value, others).mean() < 0.03


# --- urls -----------------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "http:///en/", "http://net", "http://net/", "http://Example.NET/en/", "https://a.b.EXAMPLE.net/en/x?y#z", "http://example.net/EN/", "http://example.net/en", "http://badexample.net/x", "http://notnet/x",
    "http://x.org/fr/", "http://org/fr/?a", "http://x.org?/fr/", "http://x.example.com/de/1", "http://x.example.com/#/de/", "ftp://u@h.net:80/a", "http://a.net:80/b", "http://x/?u=http://b.net/c", "http://casino-x.example.com/",
    "http://www.CASINO-win.example.com/en/", "http://a.example.com/casino-x", "http://cheap-pills.example.org/robots.txt", "http://cheap-pills.example.org/fr/a", "http://t.example.com/adserver/x/y/click?z", "http://t.example.com/adserver/click", "http://t.example.com/a?b=1&AFFID=3",
    "http://t.example.com/doorway-7.html", "http://t.example.com/doorway-7.html?x", "http://spam-farm.a.example.org/about", "http://spam-farm.example.org/about", "http://é.net/ü", "http://x.example.com/\nnew", "http://best-casino.example.com/", "http://a\tb.org/fr/x",
]


def brute_verdict(url):
    host = path = subject = ""
    if url and "://" in url:
        after = url.split("://", 1)[1]
        host = re.match("[^/?#]*", after)[0]
        rest = after[len(host) :]
        low = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        host, path, subject = low, re.match("[^?#]*", rest)[0], low + rest
    best = None
    for action, rule in url_filter.LISTED:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, action)
    if best:
        return host, path, *best
    fitting = set()
    for action, pattern in url_filter.PATTERNS:
        body = pattern.lstrip("|").rstrip("|")
        regex = "".join(".*" if c == "*" else r"(?:[^a-z0-9_.%-]|\Z)" if c == "^" else re.escape(c) for c in body)
        regex = (r"\A(?:[^/?#]*\.)?" if pattern.startswith("||") else "") + regex + (r"\Z" if pattern.endswith("|") else "")
        if subject and re.search(regex, subject, re.I | re.S):
            fitting.add(action)
    return host, path, None, "allow" if not fitting or "allow" in fitting else "block"


def test_urls(spark):
    rows = spark.createDataFrame([(k, u, "clash", "x") for k, u in enumerate(URLS + URLS[5:9])], "page_id long, url string, rule string, subject string")
    rules = url_filter.rule_table(spark, url_filter.LISTED, url_filter.PATTERNS)
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in url_filter.verdicts(rows, rules).collect()}
    assert got == {k: brute_verdict(u) for k, u in enumerate(URLS + URLS[5:9])}
    assert {v[3] for v in got.values()} == {"allow", "block"}
    assert url_filter.verdicts(rows.where("page_id < 0"), rules).count() == 0
    assert {x.verdict for x in url_filter.verdicts(rows, rules.where("action = 'x'"), default="block").collect()} == {"block"}


def test_rules_are_filed_under_their_rarest_token(spark):
    counts = spark.createDataFrame([("example", 100), ("net", 30), ("en", 50), ("casino", 2)], "token string, n long")
    rules = url_filter.rule_table(spark, url_filter.LISTED[1:2], [("block", "||casino-*x.net"), ("block", "*ads*"), ("allow", "/a.b|"), ("block", "||best*offer^now"), ("block", "new.example")])
    got = {x.pattern: x.token for x in url_filter.filed(rules, counts).collect()}
    assert got == {"||example.net/en/": "net", "||casino-*x.net": "casino", "*ads*": "", "/a.b|": "a", "||best*offer^now": "", "new.example": ""}


def test_many_rules(spark):
    """Ten thousand rules with a token of their own: each url meets the few that its tokens fetch."""
    rows = spark.createDataFrame([(k, f"http://h{k % 50}.example.com/p{k}/") for k in range(500)], "page_id long, url string")
    rules = url_filter.rule_table(spark, [("block", f"h{k}.example.com/") for k in range(10_000)], [])
    got = url_filter.verdicts(rows, rules).collect()
    assert all(x.rule == f"h{x.page_id % 50}.example.com/" for x in got)
    counts = rows.select(F.explode(url_filter.tokens(F.substring("url", 8, 100))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    assert url_filter.filed(rules, counts).where("token = 'example' OR token = 'com'").count() == 0



# --- memory of the collocations -------------------------------------------------------------------


def test_counts_are_sent_in_small_batches(monkeypatch):
    monkeypatch.setattr(collocations, "HELD", 4000)
    monkeypatch.setattr(collocations, "SENT", 300)
    g, tally, sent, sums = np.random.default_rng(4), collocations.Tally(3), [], Counter()
    for _ in range(40):
        keys = g.integers(0, 9000, 700).astype(np.uint64)
        sums.update(keys.tolist())
        sent += tally.add(keys, np.zeros(700, np.int32))
    sent += tally.rows()
    assert max(x.num_rows for x in sent) <= 300
    got = Counter()
    for x in sent:
        for k, n in zip(x.column("key").to_pylist(), x.column("n").to_pylist(), strict=True):
            got[k] += n
    assert got == sums


def test_texts_of_phrases_are_sent_by_several_tasks(spark):
    """Phrases that stand in every task: their pointers are dealt over tasks, where all went to the first one."""
    words = [f"w{k}" for k in range(400)]
    docs = spark.range(0, 80, 1, 8).select(F.lit(" ".join(words)).alias("text"), F.lit("en").alias("lang"), F.col("id").alias("doc_id"))
    found = collocations.frequent_prints(docs, [1], None, 80).collect()
    per = [sum(r.part == k for r in found) for k in range(8)]
    assert len(found) == 400 and all(r.n == 80 for r in found)
    assert sum(n > 60 for n in per) == collocations.STARTS and max(per) < 140
    rows = collocations.collocations(docs, least=80).collect()
    assert {r.phrase for r in rows} == {" ".join(words[k : k + 5]) for k in range(396)}
