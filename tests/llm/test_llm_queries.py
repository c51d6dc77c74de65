"""Every training-data query at the smallest scale: against its SQL, or against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakelayer.llm import decontaminate, exact_dedup, lang_id, line_dedup, packing, pii, simhash, suffix_dedup, warc
from lakelayer.llm.queries import ORACLES, QUERIES, tokenizer_path
from lakelayer.llm.token_files import read_metadata, read_tokens, write_token_files
from lakelayer.llm.tokens import PieceEncoder
from lakelayer.session import scratch_dir

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
# nulls, empty and blank texts, ties, repeated rows, a null id, clashing extra columns
EDGE = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (7, "É'été 1 22 <|endoftext|>"),
        (8, "word " * 3000), (9, "x" * 5000), (None, None)]


def edge(spark, rows=EDGE):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({"kept": F.lit("clash"), "_text": F.lit(1), "items": F.lit(2.0), "key": F.lit(None).cast("int")})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    from oracle_check import compare, duck
    got = compare(spark, duck(SF), key, QUERIES[key], ORACLES[key], SF)
    assert got["ok"], got


# ---- 1 repeated passages ----

def brute_passages(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = True
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(t) else 0
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("big", [20_000, 3])
def test_passages_match_brute_force(spark, monkeypatch, big):
    r = random.Random(4)
    noise = lambda n: "".join(r.choice("abcdefg hé") for _ in range(n))
    shared = noise(300)
    rows = EDGE + [(100 + i, noise(r.randint(0, 90)) + shared[i % 40:i % 40 + r.randint(150, 240)] + noise(60))
                   for i in range(60)] + [(300, "ab" * 400), (301, shared), (302, shared), (303, shared[:200])]
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (big,))
    got = suffix_dedup.repeated_passages(spark.createDataFrame(rows, SCHEMA), length=200, gram=48).drop("spans")
    assert Counter(map(tuple, got.collect())) == Counter(brute_passages(rows, 200))
    assert suffix_dedup.repeated_passages(empty(spark)).count() == 0


# ---- 2 language ----

def test_language_is_learned_and_held_out(spark):
    got = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    assert got.where("score < 0 or score > 1").count() == 0
    for i, h in got.select("doc_id", "held_out").limit(50).collect():
        assert h == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_language_edges_and_switching(spark):
    model = lang_id.fit(docs(spark), F.lit(True))
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in lang_id.label(edge(spark), model).collect()}
    assert got[(1, None)] == got[(2, "")] == got[(3, "  \n\t ")] == ("und", 0.0)
    assert got[(4, "one")][0] in model.labels
    assert lang_id.label(empty(spark), model).count() == 0
    assert lang_id.fit(docs(spark).withColumn("lang", F.lit(None).cast("string")), F.lit(True)).labels == []
    post = lang_id.Labeller(model).posteriors("the and of the with und der die nicht und".split())
    best = [model.labels[i] for i in post.argmax(axis=1)]
    assert best[0] == "en" and best[-1] == "de"


def test_lexicon_serves_more_than_eight_labels(spark):
    r = random.Random(13)
    k = 11
    own = [["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(12)] for _ in range(k)]
    pair = ["zzyzx"]                               # in the lexicons of two languages
    rows = [(i, " ".join(r.choice(own[i % k] + (pair if i % k < 2 else [])) for _ in range(30)), f"l{i % k:02}")
            for i in range(60 * k)]
    df = spark.createDataFrame(rows, SCHEMA + ", lang string")
    model = lang_id.fit(df, ~lang_id.held_out())
    assert len(model.labels) == k and model.weights.shape == (lang_id.BUCKETS + k, k)
    assert model.lexicon[b"zzyzx"] == [0, 1]
    for y, words in enumerate(own):
        for w in words:
            assert model.lexicon[w.encode()] == [y]
        assert model.weights[lang_id.BUCKETS + y].argmax() == y
    who, feature = model.features([b"zzyzx", b"unseen", own[10][0].encode()])
    lex = feature >= lang_id.BUCKETS
    assert list(zip(who[lex], feature[lex] - lang_id.BUCKETS)) == [(0, 0), (0, 1), (2, 10)]
    assert lang_id.word_features([b"unseen"])[1].tolist() == model.features([b"unseen"])[1].tolist()
    got = lang_id.label(df, model).where(lang_id.held_out())
    assert got.where("lang != lang_pred").count() == 0


def test_forward_backward_matches_enumeration():
    import itertools
    r = np.random.default_rng(1)
    emit, trans, first = r.normal(size=(4, 1, 3)), r.normal(size=(3, 3)), r.normal(size=3)
    weight = {p: np.exp(first[p[0]] + emit[range(4), 0, p].sum() + sum(trans[a, b] for a, b in zip(p, p[1:])))
              for p in itertools.product(range(3), repeat=4)}
    z = sum(weight.values())
    post, logz, _ = lang_id.forward_backward(emit, np.array([4]), trans, first)
    assert np.isclose(logz[0], np.log(z))
    want = np.array([[sum(w for p, w in weight.items() if p[t] == k) / z for k in range(3)] for t in range(4)])
    assert np.allclose(post[:, 0], want)
    e = np.exp(np.concatenate([emit, emit], axis=1)).astype(np.float32)
    mean = lang_id.mean_posteriors(e, np.array([4, 2]), trans, first)
    assert np.allclose(mean[0], want.mean(axis=0), atol=1e-4)
    short = lang_id.forward_backward(emit[:2], np.array([2]), trans, first)[0][:, 0].mean(axis=0)
    assert np.allclose(mean[1], short, atol=1e-4)


# ---- 3 WARC ----

def test_warc_round_trip_and_edges(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/", "<p>x &amp; y</p><script>bad</script><a href=\"/z\">l</a>\r\n\r\nWARC/1.1"), (2, None, None), (2, None, None),
         (None, "http://b/", "HTTP/1.1 404 No\r\nContent-Type: text/html\r\nX-A: b\r\n\r\n<title>T</title>")],
        "page_id long, url string, html string").withColumn("block", F.lit(1))
    rec = warc.derived_records(pages)
    rows = rec.collect()
    assert len(rows) == 8 and len({r.refers_to for r in rows}) == 3
    text = {r.target_uri: r for r in rows if r.record_type == "conversion"}
    assert text["http://a/"].block.startswith("x & y") and "bad" not in text["http://a/"].block
    meta = next(r for r in rows if r.record_type == "metadata" and r.target_uri == "http://b/")
    assert "status: 404" in meta.block and "title: T" in meta.block and "X-A: b" in meta.source_headers
    path = scratch_dir(spark, "warc")
    warc.write_warc(rec, path, "2000-01-01T00:00:00Z", per_file=3)
    back = Counter((r.headers["WARC-Record-ID"], r.headers["WARC-Refers-To"], r.headers["WARC-Block-Digest"], r.block)
                   for r in warc.read_warc(spark, path).collect())
    assert back == Counter((r.record_id, r.refers_to, r.block_digest, r.block) for r in rows)
    assert warc.derived_records(pages.limit(0)).count() == 0


def test_warc_links_in_every_quoting(spark):
    from html.parser import HTMLParser

    class Links(HTMLParser):
        def handle_starttag(self, tag, attrs):
            found.extend(v for k, v in attrs[:] if tag == "a" and k == "href" and v is not None)

    pages = ["<a href='/one'>1</a><a href=/two>2</a><A HREF=\"/three\">3</A>", "<a class=x href = '/a b' id=q>l</a><abbr href='/no'>",
             "<a title='see href=/no' href='/yes'>l</a>", "<a data-href='/no' href=/yes?a=b&c>l</a><a name=x>t</a>",
             "<a title=\"a > b\" href='/q\"r'>x</a>", "<a\nhref=''>e</a><a href=\"/x='y'\">f</a>", "no link <p href=/z>", "",
             "i <a then " + "word \"q\" it's = 'v' " * 20000, "<a " + "x='1' " * 50 + "href=/far>"]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").withColumn("url", F.lit("u"))
    got = {int(r.page_id): re.findall(r"outlink: (.*?) L a/@href\r\n", r.block)
           for r in warc.derived_records(df).where("record_type = 'metadata'").collect()}
    for i, page in enumerate(pages):
        found: list[str] = []
        if i != 8:                                  # no tag, but a long run of text after an open one
            Links(convert_charrefs=False).feed(page)
        assert got[i] == found, page[:80]
    assert sum(map(len, got.values())) == 10


# ---- 4 SimHash ----

def brute_fingerprint(text):
    import xxhash
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows))


def test_simhash_matches_brute_force(spark):
    base = [(r.doc_id, r.text) for r in docs(spark).collect()]
    words = [f"w{i}" for i in range(300)]
    near = [(5000 + i, " ".join(words[:i * 3] + ["new"] + words[i * 3 + 1:])) for i in range(90)]
    rows = base + near + EDGE
    got = simhash.near_duplicate_query(spark.createDataFrame(rows, SCHEMA))
    assert Counter(map(tuple, got.collect())) == brute_components(rows)
    assert simhash.near_duplicate_query(empty(spark)).count() == 0


@pytest.mark.parametrize("block", [8192, 7])
def test_simhash_links_lose_no_component(spark, block):
    r = random.Random(2)
    fps = set()
    for _ in range(40):
        c = r.getrandbits(64)
        for _ in range(20):
            x = c
            for b in r.sample(range(64), r.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    root = {n: k for n, k in simhash.components(simhash.links(df, 3, block)).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    label = {f: f for f in signed}
    changed = True
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    while changed:
        changed = False
        for a, b in pairs:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    assert {f: root.get(f, f) for f in signed} == label


def test_one_per_group(spark):
    kept = simhash.one_per_group(exact_dedup.distinct_rows(edge(spark)))
    assert kept.columns == edge(spark).columns
    got = sorted((r.doc_id or -1) for r in kept.collect())
    assert got == [1, 4, 7, 8, 9]          # null, empty and blank texts share fingerprint zero


# ---- 5 decontamination ----

def test_contamination_blocks_and_edges(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma"), (1, "alpha beta gamma"), (2, None), (3, "!!"), (None, "solo"),
                                   (10, " ".join(f"k{i}" for i in range(14)))], "item_id long, text string")
    rows = EDGE + [(20, "so ALPHA, beta: gamma. alpha beta"), (21, " ".join(f"k{i}" for i in range(2, 14))), (22, "solo solo")]
    for bits in (1 << 26, 64):                 # with 64 bits the filter passes nearly every shingle on
        got = {r.doc_id: r for r in decontaminate.contamination(edge(spark, rows), items, filter_bits=bits).collect()}
        assert (got[20].n_words, got[20].n_hit, got[20].n_items) == (6, 3, 1)
        assert (got[21].n_hit, got[21].items_sha256) == (12, hashlib.sha256(b"10").hexdigest())
        assert (got[22].n_hit, got[22].n_items) == (2, 1) and got[22].items_sha256 == hashlib.sha256(b"").hexdigest()
        assert not got[1].contaminated and got[1].n_words == 0
    assert decontaminate.contamination(empty(spark), items).count() == 0
    assert decontaminate.contamination(edge(spark), items.limit(0)).where("contaminated").count() == 0


def test_contamination_counts_words_by_their_bytes(spark):
    """Words are counted on Arrow columns, not cut out one by one with a regular expression."""
    texts = [None, "", " ", "a", " a", "a ", "a b", "A1-b2_c3\td\n", "É日本 x\u00a0y", "\x7f\x00", "@[`{", "é" * 5, "a" * 70_000, "a " * 70_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = decontaminate.find_windows(df, spark.createDataFrame([(1, "no such item")], "item_id long, text string"))
    assert "regexp" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id: r.n_words for r in out.collect()} == {i: len(words(t)) for i, t in enumerate(texts)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_contamination_equals_brute_force(spark):
    r = random.Random(8)
    vocab = ["a", "B", "c", "É", "日本", "x" * 300_000]       # a word longer than what is hashed at once

    def text(n):
        return "".join(r.choice(vocab[:5]) + r.choice([" ", "  ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(r.choice([0, 1, 2, 3, 5, 6, 7]))) for i in range(40)] + [(40, f"a {vocab[5]} c"), (41, "a " * 40)]
    rows = [(i, text(r.randint(0, 60))) for i in range(80)]
    rows += [(80, f"B a {vocab[5].upper()} c"), (81, f"a {vocab[5]}x c"), (82, "a " * 70), (82, "a " * 70), (83, None)]
    df = spark.createDataFrame([(i, t, i, "kept", "own") for i, t in rows],
                               "doc_id long, text string, n_words long, key string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_windows(df, bench, window=4, filter_bits=1 << 16).collect()
    assert len(got) == len(rows)
    wanted = [(i, w[s:s + 4]) for i, t in items if (w := words(t)) for s in range(max(1, len(w) - 3))]
    texts = dict(rows)
    for row in got:
        w = words(texts[row.doc_id])
        hit, names = set(), set()
        for i, win in wanted:
            for s in range(len(w) - len(win) + 1):
                if w[s:s + len(win)] == win:
                    hit.update(range(s, s + len(win)))
                    names.add(str(i))
        assert row.key == "kept" and row.n_words == len(w) and row["items"] == sorted(names)
        assert [p for s in row.hit_spans for p in range(s.start, s.stop)] == sorted(hit)
        assert all(a.stop < b.start for a, b in zip(row.hit_spans, row.hit_spans[1:]))


# ---- 6 and 8 tokens ----

@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_piece_encoder_equals_direct(spark, name):
    from tokenizers import Tokenizer
    r = random.Random(5)
    bits = [" ", "  ", "\n", " \n", "a", "B", "!!", "'s", "'", "é", "é", "́", "12", "\xa0", "\t", "<|endoftext|>", "<|",
            "\x1c", "Σ", "日本", "😀", "\0", ".", "\r\n", "\u0085", "x" * 60]
    texts = [x.text for x in docs(spark).collect()] + ["".join(r.choice(bits) for _ in range(12)) for _ in range(3000)] + [""]
    direct, enc = Tokenizer.from_file(tokenizer_path(name)), PieceEncoder(tokenizer_path(name), cap=300)
    for i in range(0, len(texts), 50):
        want = [np.array(e.ids, "<i4").tobytes() for e in direct.encode_batch(texts[i:i + 50], add_special_tokens=False)]
        assert enc.encode(texts[i:i + 50]) == want


def test_word_pieces_are_kept_once():
    """A word is one remembered piece, whatever its case and the signs behind it."""
    from tokenizers import Tokenizer
    name = "word_bpe_49k.json"
    enc, direct = PieceEncoder(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    texts = [" Word, WORD. word! Word2 wOrd", " WORD", None, "H\u0331 K\u0301. don'T x'S!'s I'LL <\u0338 a<b<|ENDOFTEXT|> A"]
    got = enc.encode(texts)
    assert got == [np.array(direct.encode(t or "", add_special_tokens=False).ids, "<i4").tobytes() for t in texts]
    assert {p for p in enc.new if "word" in p.lower()} == {" word"}


def ids_of(name, text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path(name)).encode(text or "", add_special_tokens=False).ids + [1]


def test_token_files_round_trip(spark):
    path = scratch_dir(spark, "tokens")
    write_token_files(edge(spark), path, tokenizer_path("word_bpe_49k.json"), 1)
    got = read_tokens(spark, path).orderBy("start").collect()
    order = sorted(EDGE, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    assert [(r.doc_id, list(r.tokens)) for r in got] == [(d, ids_of("word_bpe_49k.json", t)) for d, t in order]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [tuple(r) for r in read_metadata(spark, path).orderBy("start").collect()] == [
        (r.doc_id, r.start, r.n_tokens) for r in got]
    assert {r.doc_id for r in read_tokens(spark, path, 4, 7).collect()} == {4, 5, 7}
    none = scratch_dir(spark, "tokens")
    write_token_files(empty(spark), none, tokenizer_path("word_bpe_49k.json"), 1)
    assert read_tokens(spark, none).count() == 0


def check_pieces(rows, window):
    """Pieces tile their documents, sequences are gapless, and each is full or a power of two long."""
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == window or at & (at - 1) == 0


@pytest.mark.parametrize("open_limit", [4096, 2])
def test_packing_round_trip(spark, open_limit):
    rows = [r for r in EDGE if r[0] not in (None, 5)] + [(r.doc_id + 100, r.text) for r in docs(spark).collect()]
    name = "byte_bpe_50k.json"
    got = packing.pack(spark.createDataFrame(rows, SCHEMA), tokenizer_path(name), 1, window=256,
                       open_limit=open_limit).collect()
    check_pieces(got, 256)
    per = {}
    for r in got:
        per.setdefault(r.doc_id, []).append(r)
    for d, t in rows:
        ids, at = ids_of(name, t), 0
        for p in sorted(per[d], key=lambda p: p.start):
            raw = np.array(ids[p.start:p.start + p.length], "<u4").tobytes()
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(raw)
            at += p.length
        assert at == len(ids)
    assert packing.pack(empty(spark), tokenizer_path(name), 1).count() == 0


def test_packer_minimises_squares():
    r = np.random.default_rng(3)
    p = packing.Packer(16, 10 ** 6)
    for n in r.integers(1, 16, 400):
        want = {}
        for h in range(16 - int(n) + 1):
            if h == 0 or p.counts[h]:
                c = p.counts.copy()
                c[h] -= h > 0
                if h + n < 16:
                    c[h + n] += 1
                want[h] = int((c[1:16] ** 2).sum())
        assert want[p.level(int(n))] == min(want.values())
        p.add(0, b"\0\0\0\0" * int(n))


# ---- 7 personal data ----

RX = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
      "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(t):
    out = []
    for k, p in RX.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if (k == "ip" and any(int(x) > 255 for x in m[0].split(".")) or k == "phone" and not 10 <= len(d) <= 15
                    or k == "card" and not (14 <= len(d) <= 19 and pii.luhn(d))):
                continue
            out.append((k, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_match_patterns(spark):
    r = random.Random(6)
    texts = ["".join(r.choice("ab@@..12 3-+()_é") for _ in range(30)) for _ in range(5000)]
    texts += ["".join(r.choice("0123456789 -.+") for _ in range(60)) for _ in range(5000)]
    texts += [x.text for x in docs(spark).collect()] + ["4111 1111 1111 1111", "+1 (743) 555-3824", "a@b.c.d_e@f.gh"]
    for t in texts:
        assert pii.base_spans(t) == brute_spans(t), t
    assert pii.base_spans("1" * 100_000 + "a" * 100_000 + "@") == []


def test_model_learns_and_adds(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    filler = d.where("text rlike '^[^0-9@]+$'").limit(200).select("text").collect()
    r = random.Random(8)
    rows = [(i, x.text[:60] + f" +1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)} mail.{i}@ex{i}.example.com " + x.text[60:120])
            for i, x in enumerate(filler)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = pii.fit(df, rounds=12)
    tagger, found, total = pii.Tagger(model, 96, 0.5), 0, 0
    for _, t in rows[:80]:
        base = set(pii.base_spans(t))
        found, total = found + len(base & set(tagger.spans([t])[0])), total + len(base)
    assert found > 0.8 * total
    got = {x.doc_id: x for x in pii.personal_data(edge(spark), model).collect()}
    assert got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.fit(edge(spark)) is None
    assert pii.personal_data(edge(spark), None).count() == len(EDGE)
    assert pii.personal_data(empty(spark), model).count() == 0


@pytest.mark.parametrize("inside", [False, True])          # whether the model learns from the planted rows, too
def test_defaults_add_numbers_off_the_patterns(spark, inside):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    r = random.Random(3)
    filler = d.where("text rlike '^[^0-9@]+$'").orderBy("doc_id").limit(300).select("text").collect()
    cards = [c for c in (f"4{r.randrange(10 ** 15):015}" for _ in range(600)) if pii.luhn(c)]
    rows, want = [], {}
    for i, x in enumerate(filler):
        n = (f"1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}" if i % 10 == 0 else
             ".".join(cards[i // 10][k:k + 4] for k in range(0, 16, 4)) if i % 10 == 1 else
             f"in {r.randint(1900, 2030)} about {r.randint(10, 99)}.{r.randint(1, 9)} of {r.randint(1000, 9999)}")
        t = f"{x.text[:80]} {n} {x.text[80:160]}"
        rows.append((-1 - i, t))
        if i % 10 < 2:
            assert not pii.base_spans(t)
            want[-1 - i] = f"{('phone', 'card')[i % 10]}:{t.index(n)}:{t.index(n) + len(n)}"
    df = spark.createDataFrame(rows, SCHEMA)
    model = pii.fit(d.union(df) if inside else d)
    got = {x.doc_id: x for x in pii.personal_data(df, model).collect()}
    for kind in ("phone", "card"):
        mine = [i for i, w in want.items() if w.startswith(kind)]
        assert sum(got[i].spans == want[i] and got[i].n_added == 1 for i in mine) >= 0.8 * len(mine), kind
    assert sum(got[i].n_added for i, _ in rows if i not in want) == 0


def test_unknown_tags_are_summed_over():
    m = pii.BiLstmCrf(hidden=3)
    r = np.random.default_rng(1)
    m.p["trans"] = r.normal(0, 0.5, m.p["trans"].shape)
    codes, tags = r.integers(0, 98, (1, 5)), np.array([[0, -1, -1, 0, 3]])
    filled = [np.array([[0, a, b, 0, 3]]) for a in range(pii.LABELS) for b in range(pii.LABELS)]
    want = np.logaddexp.reduce([5 * m.likelihood(codes, t) for t in filled])
    assert np.isclose(5 * m.likelihood(codes, tags), want)
    g = m.gradients(codes.T, tags.T)
    for k in ("out", "trans", "rf", "xb"):
        flat = m.p[k].reshape(-1)
        for i in np.argsort(-np.abs(g[k].reshape(-1)))[:3]:
            old, flat[i] = flat[i], flat[i] + 1e-5
            up = m.likelihood(codes, tags)
            flat[i] = old - 1e-5
            down = m.likelihood(codes, tags)
            flat[i] = old
            assert np.isclose((up - down) / 2e-5, g[k].reshape(-1)[i], rtol=1e-3, atol=1e-7), k
    assert pii.masked_tags("a 123 456-7890 b", []).tolist() == [0, 0] + [-1] * 12 + [0, 0]
    assert pii.masked_tags("12345678901", [("phone", 0, 11)]).min() > 0 and pii.masked_tags("1234567 1/2", []).max() == 0


def test_gradients_match_differences():
    m = pii.BiLstmCrf(hidden=3)
    r = np.random.default_rng(0)
    codes, tags = r.integers(0, 98, (7, 2)), np.array([[0, 1], [1, 2], [2, 2], [0, 0], [3, 0], [4, 5], [0, 6]])
    n, lanes = np.indices(tags.shape)

    def loss():
        emit = m.scores(codes)[0]
        gold = emit[n, lanes, tags].sum() + m.p["first"][tags[0]].sum() + m.trans()[tags[:-1], tags[1:]].sum()
        return (gold - lang_id.forward_backward(emit, np.array([7, 7]), m.trans(), m.p["first"])[1].sum()) / tags.size

    g = m.gradients(codes, tags)
    for k in ("out", "bias", "first", "rf", "rb", "xf", "xb"):
        flat = m.p[k].reshape(-1)
        for i in np.argsort(-np.abs(g[k].reshape(-1)))[:3]:
            old, flat[i] = flat[i], flat[i] + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert np.isclose((up - down) / 2e-5, g[k].reshape(-1)[i], rtol=1e-3, atol=1e-7), k


# ---- 9 exact dedup, 10 lines ----

@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_groups_and_hot_text(spark, keep):
    rows = EDGE + [(1000 + i, "hot") for i in range(200)]
    got = exact_dedup.duplicate_groups(edge(spark, rows), keep=keep).collect()
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
    pick = min if keep == "min" else max
    for t, ids in groups.items():
        sha = hashlib.sha256(t.encode()).hexdigest()
        mine = [r for r in got if r.text_sha256 == sha]
        real = [i for i in ids if i is not None]
        assert Counter(r.doc_id for r in mine) == Counter(ids)
        assert {(r.keep_id, r.group_size) for r in mine} == {(pick(real) if real else None, len(ids))}
        assert [r.doc_id for r in mine if r.kept] == [pick(real) if real else None]
    kept = exact_dedup.distinct_rows(edge(spark, rows), keep=keep)
    assert kept.columns == edge(spark).columns and kept.count() == len(groups)
    assert exact_dedup.duplicate_groups(empty(spark)).count() == 0 and exact_dedup.distinct_rows(empty(spark)).count() == 0


def edit_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_lines_match_brute_force(spark):
    r = random.Random(9)
    lines = ["".join(r.choice("ab é") for _ in range(r.randint(18, 24))) for _ in range(25)] + ["", "ab", "ac"]

    def twist(s):
        i, how = r.randrange(len(s) + 1), r.randrange(4)
        return s if how == 0 else s[:i] + r.choice("xyé") + s[i:] if how == 1 else s[:i] + s[i + 1:] if how == 2 else s[:i] + "q" + s[i + 1:]

    rows = [(i, "\n".join(twist(r.choice(lines)) for _ in range(r.randint(1, 6)))) for i in range(70)] + [(900, None), (901, "")]
    want, before = {}, []
    for d, t in sorted(rows):
        gone = []
        for no, line in enumerate([] if t is None else t.split("\n")):
            if line and any(line == o or len(line) >= 20 and len(o) >= 20 and edit_one(line, o) for o in before):
                gone.append(no)
            before += [line] if line else []
        want[d] = (0 if t is None else len(t.split("\n")), gone)
    df = spark.createDataFrame(rows, SCHEMA)
    found = line_dedup.duplicate_lines(df, near_length=20)
    got = {x.doc_id: (x.n_lines, list(x.removed)) for x in found.collect()}
    assert got == want
    clean = {x.doc_id: x.text for x in line_dedup.without_lines(df, found).collect()}
    for d, t in rows:
        assert clean[d] == (None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[d][1]))
    assert line_dedup.duplicate_lines(empty(spark)).count() == 0
    assert line_dedup.duplicate_lines(edge(spark)).count() == 10       # the two equal rows are one document


def test_short_lines_match_brute_force(spark):
    r = random.Random(12)
    lines = ["".join(r.choice("ab é😀") for _ in range(r.randint(0, 22))) for _ in range(220)]
    lines += ["With, to to.", "With to to.", "Heti, eror anesti.", "Heti eror anesti.", "a", "b", "é", "ab", "x" * 19, "x" * 20]
    r.shuffle(lines)
    rows = [(i, "\n".join(lines[i * 3:i * 3 + 3])) for i in range(77)] + [(900, None), (901, "")]
    want, before = {}, []
    for d, t in rows:
        own = [] if t is None else t.split("\n")
        gone, near = [], 0
        for no, line in enumerate(own):
            if line and any(edit_one(line, o) for o in before):
                gone.append(no)
                near += line not in before
            before += [line] if line else []
        want[d] = (len(own), len(gone), near, ",".join(map(str, gone)))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {x.doc_id: tuple(x)[1:] for x in line_dedup.line_dedup_query(df, near_length=1).collect()}
    assert got == want
    # the registered query takes the short lines in, too
    path = scratch_dir(spark, "lines")
    df.coalesce(1).write.parquet(f"{path}/documents.parquet")
    assert {x.doc_id: tuple(x)[1:] for x in QUERIES["op10_line_dedup"](spark, path).collect()} == want


# ---- pipeline ----

def test_pipeline_against_brute_force(spark):
    import corpus_pipeline as c
    d = docs(spark)
    rows = [(r.doc_id, r.text) for r in d.collect()]
    stage = dict(c.STAGES)
    out = stage["language_id"](spark, d, SF)
    assert out.columns == d.columns
    rows = [(i, t) for i, t in rows if any(ch.isalpha() for ch in t)]
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, _ in rows)
    out = stage["exact_dedup"](spark, out, SF)
    first = {}
    for i, t in sorted(rows):
        first.setdefault(t, i)
    rows = [(i, t) for t, i in first.items()]
    assert out.columns == d.columns and sorted(r.doc_id for r in out.collect()) == sorted(i for i, _ in rows)
    out = stage["simhash_near_dedup"](spark, out, SF)
    keep = {k[2] for k in brute_components(rows)}
    rows = [(i, t) for i, t in rows if i in keep]
    assert out.columns == d.columns and sorted(r.doc_id for r in out.collect()) == sorted(keep)
    out = stage["decontamination"](spark, out, SF)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    dirty = {i for i, bad in con.sql(f"SELECT doc_id, contaminated FROM ({ORACLES['op5_decontamination']})").fetchall() if bad}
    assert out.columns == d.columns and {r.doc_id for r in out.collect()} == keep - dirty
    pieces = stage["packing"](spark, out, SF).collect()
    check_pieces(pieces, 2048)
    assert {p.doc_id for p in pieces} == keep - dirty
    assert Counter(map(tuple, c.run(spark, SF).select("doc_id", "start", "doc_tokens").where("start = 0").collect())) == Counter(
        (p.doc_id, p.start, p.doc_tokens) for p in pieces if p.start == 0)


def test_language_stage_needs_no_labels(spark):
    import corpus_pipeline as c
    texts = [None, "", " 12 -", "one", "\u0663\u0664", "\u65e5\u672c", "caf\u00e9 1", "\u2167", "K", "1\u00e9"]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA + ", lang string")
    out = c.language(spark, df, SF)
    assert out.columns == df.columns
    want = [i for i, t in enumerate(texts) if any(ch.isalpha() for ch in t or "")]
    assert sorted(r.doc_id for r in out.collect()) == want == [3, 5, 6, 8, 9]
    assert [lang_id.has_letter(t or "") for t in texts] == [bool(lang_id.words_of(t or "")) for t in texts]
    bare = c.language(spark, docs(spark).withColumn("lang", F.lit(None).cast("string")), SF)
    full = c.language(spark, docs(spark), SF)
    assert sorted(r.doc_id for r in bare.collect()) == sorted(r.doc_id for r in full.collect()) != []


CLASH = {c: i for i, c in enumerate(["_text", "n_words", "items", "hit_spans", "_no_text", "_row", "_id", "_wth", "_wid", "_lang_pred",
                                     "_lang_letter", "kept", "h", "corpus_pipeline_carried_columns2", "key"])}


@pytest.mark.parametrize("name", ["language_id", "exact_dedup", "simhash_near_dedup", "decontamination"])
def test_stages_keep_columns_of_any_name(spark, name):
    import corpus_pipeline as c
    rows = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "one"), (5, "an only text here"), (6, "x" * 3000), (None, None)]
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA + ", lang string").withColumns(
        {k: F.lit(f"{k}-{v}") for k, v in CLASH.items()})
    out = dict(c.STAGES)[name](spark, df, SF)
    got = out.collect()
    assert out.columns == df.columns and got
    for r in got:
        assert (r.doc_id, r.text) in rows and all(r[k] == f"{k}-{v}" for k, v in CLASH.items())
    assert dict(c.STAGES)[name](spark, df.where("false"), SF).collect() == []
    if name == "decontamination":
        assert len(got) == len(rows)
    if name == "exact_dedup":
        assert sorted(r.doc_id or 0 for r in got) == [1, 3, 5, 6]


def test_links_of_tags_with_many_attributes(spark):
    from lakelayer.llm.warc import _links
    html = "<a " + " ".join(f"data-{i}='{i}>'" for i in range(20_000)) + " href='/far'>x</a><a href=/near>y</a>"
    assert spark.createDataFrame([(html,)], "html string").select(_links(F.col("html"))).first()[0] == ["/far", "/near"]
