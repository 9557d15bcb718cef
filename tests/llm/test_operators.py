"""Each text operator on odd input - nulls, empty and long texts, ties, repeated rows, an empty table, clashing columns - and
against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL

from riskflow.llm import ann, chat_quotes, decontaminate, encoding, flat, language_id, near_dup, packing, queries, secret_scan, suffix_dedup, token_store, toxicity

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(random.Random(1).choices(WORDS, k=30_000))
ROWS = [(1, "hello world again and again"), (2, None), (3, ""), (4, LONG), (4, LONG), (5, "hello world again and again"), (None, "a  b\n c"), (6, "password=abcdef123 x"), (7, " \n\t "), (8, "ß" * 5000)]
SCHEMA = "doc_id long, text string, lang string, blob string, spans string, score double, row long, n int, key long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "x", "y", 1.0, 1, 1, 1) for i, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, None if i == 3 else i % 2) for i in range(9)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, " ".join(LONG.split(" ")[100:140]), "x"), (2, None, "x"), (3, "too short", "x"), (1, " ".join(LONG.split(" ")[100:140]), "x")], "item_id long, text string, doc_id string")


def operators(labels, bench):
    return {
        "secret": lambda d: secret_scan.digest(secret_scan.scan_versions(d)),
        "redact": secret_scan.redact,
        "language": lambda d: language_id.identify(d, queries.vocabulary("pieces")),
        "planes": lambda d: token_store.store_tokens(d, queries.vocabulary("bytes"), 2),
        "bits": lambda d: token_store.store_tokens(d, queries.vocabulary("bytes"), 2, mode="bit"),
        "leaks": lambda d: decontaminate.contaminated(d, bench),
        "toxicity": lambda d: toxicity.toxicity(d, labels),
        "suffix": lambda d: suffix_dedup.digest(suffix_dedup.without_repeats(d)),
        "near": near_dup.near_duplicates,
        "packing": lambda d: packing.pack(d, queries.vocabulary("words"), 1),
    }


@pytest.mark.parametrize("name", ["secret", "redact", "language", "planes", "bits", "leaks", "toxicity", "suffix", "near", "packing"])
def test_odd_and_empty_tables(odd, labels, bench, name):
    run = operators(labels, bench)[name]
    assert run(odd.limit(0)).count() == 0
    got = run(odd).collect()
    if name == "leaks":
        assert [(r.doc_id, r.item_id, r.similarity, r.start) for r in got] == [(4, 1, 1.0, 100)]
    elif name == "packing":
        assert sum(r.length for r in got) == sum({(r.doc_id, r.doc_tokens, k): r.doc_tokens for k, r in enumerate(got) if r.start == 0}.values())
    else:
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ROWS)
    if name == "near":
        classes = [(r.doc_id, r.class_id) for r in got]
        assert (5, 1) in classes and (3, 2) in classes and (7, 2) in classes and classes.count((4, 4)) == 2
    if name == "redact":
        assert set(got[0].asDict()) == set(odd.columns) and [r.text for r in got if r.doc_id == 6] == ["[secret] x"]
    if name == "suffix":
        assert all(r.n_removed == r.n_bytes for r in got if r.doc_id == 4)


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer

    r = random.Random(2)
    texts = ["", None, " ", "a  b", "x\n  y", "it's 12 3", "foo<|endoftext|> bar", "<|endoftext|>", "a <|startoftext|><|ENDOFTEXT|> b", "ΟΔΟΣ ΟΔΟΣ."] + ["".join(r.choice("a b\n\t '1.é\x85") for _ in range(r.randint(0, 30))) for _ in range(500)]
    for kind in ("bytes", "words"):
        path = queries.vocabulary(kind)
        plain = Tokenizer.from_file(path)
        ids, counts = encoding.ChunkEncoder(path).encode(texts, 7)
        want = [plain.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
        assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == list(map(len, want))


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_planes_round_trip(mode):
    import io

    ids, out = np.random.default_rng(0).integers(0, 50_000, 5000).astype(np.uint32), io.BytesIO()
    writer = token_store.PlaneWriter(out, block=512, mode=mode)
    writer.add([1, None, 3], ids, np.array([1000, 0, 4000]))
    writer.close()
    reader = token_store.PlaneReader(out)
    assert (reader.ids(0, 5000) == ids).all() and (reader.ids(700, 1300) == ids[700:1300]).all() and reader.null.tolist() == [False, True, False]


def test_ledger_scans_a_pair_of_blob_and_rule_once(spark, tmp_path, monkeypatch):
    ledger, df = f"file://{tmp_path}/ledger", spark.createDataFrame([("a", 1, "token: abcdef99"), ("b", 1, "token: abcdef99")], "path string, version int, text string")
    assert {r.spans[0].kind for r in secret_scan.scan_versions(df, ledger).collect()} == {"assign"}
    more = df.union(spark.createDataFrame([("a", 2, "AKIA" + "A" * 16)], "path string, version int, text string"))
    assert secret_scan.scan_versions(more, ledger).count() == 3
    rows = spark.read.parquet(ledger)
    assert rows.count() == 2 * 3 == rows.select("blob", "rule").distinct().count()
    # One rule changes: old blobs are read for it alone.
    rules = (*secret_scan.RULES[:2], secret_scan.Rule("hex", r"[0-9a-f]+", 5))
    got = {(r.path, r.version): [s.kind for s in r.spans] for r in secret_scan.scan_versions(more, ledger, rules=rules).collect()}
    assert got == {("a", 1): ["assign", "hex"], ("b", 1): ["assign", "hex"], ("a", 2): ["access"]} and spark.read.parquet(ledger).count() == 8
    # An append that was repeated changes nothing.
    spark.read.parquet(ledger).write.mode("append").parquet(f"{tmp_path}/again")
    spark.read.parquet(f"{tmp_path}/again").write.mode("append").parquet(ledger)
    assert secret_scan.scan_versions(more, ledger).count() == 3


def test_secret_query_against_brute_force(spark, tmp_path):
    """The three base patterns as the contract words them, on whole texts: the table's, and those with secrets, near misses and ties."""
    import re

    patterns = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII, 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 0, 20), ("hex", r"[0-9a-f]+", 0, 0, 24)]
    key, sha = "AKIA" + "Z9" * 8, "0123456789abcdef" * 2
    planted = [f"password = '{sha}'", f"x API_KEY:{key}; apikey={key}", f"é\U0001f600 {key} {sha}", "token: abc", "AKIASHORT " + sha[:23], f"{'word ' * 5000}SECRET=\"{sha}\"", f"secret=token:abcdef passwd=secret=x{sha}", f"AKIAAKIA{key}", f"passwd  =  {key}{sha}", None, "", f"password = '{sha}'"]
    documents = queries.table(spark, SMALL, "documents").select("doc_id", "text")
    extra = spark.createDataFrame([(1_000_000 + k, x) for k, x in enumerate(planted)], "doc_id long, text string")
    documents.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    text = {r.doc_id: r.text or "" for r in queries.table(spark, str(tmp_path), "documents").collect()}
    found = 0
    for r in queries.op1_secret_scan(spark, str(tmp_path)).collect():
        spans = [(m.start(), k, kind, m.end()) for k, (kind, p, flags, group, least) in enumerate(patterns) for m in re.finditer(p, text[r.doc_id], flags) if len(m[group]) >= least]
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
        assert (r.base_sha256, r.spans) == (hashlib.sha256(listed.encode()).hexdigest(), listed)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        found += len(spans)
    assert found > 5


def test_language_forward_sums_all_segmentations():
    pieces = language_id.pieces_of(queries.vocabulary("pieces"))
    prob = np.random.default_rng(0).random((pieces.size, 2)) * 1e-3
    word = "thanden"
    words = language_id.Words(np.array([ord(c) for c in word], np.uint32), np.array([len(word)]))
    own = {}
    for _, at, piece, n in words.occurrences(pieces):
        own |= {(int(a), n): int(p) for a, p in zip(at, piece, strict=True)}

    def total(i, lang):
        if i == len(word) + 1:
            return 1.0
        out = 0.0
        for n in range(1, len(word) + 2 - i):
            p = prob[own[i, n], lang] if (i, n) in own else 0.0
            out += (max(p, language_id.FLOOR) if n == 1 else p) * total(i + n, lang)
        return out

    expected = np.zeros((pieces.size, 2))
    got = language_id.forward(words, pieces, prob, expected, np.ones((1, 2)))
    assert np.allclose(got[0], np.log([total(0, 0), total(0, 1)])) and (expected.sum(0) > 1).all()


def test_words_are_tallied_over_batches(monkeypatch):
    path = queries.vocabulary("pieces")
    texts = [("eins zwei drei zwei", "de"), ("one two three two eins", "en"), ("", "en"), ("zwei " * 50 + "x" * 300, "de"), ("tres dos dos", "es")]

    def batches(size):
        return iter(pa.table({"text": [t for t, _ in texts], "lang": [x for _, x in texts]}).to_batches(max_chunksize=size))

    def counts(prob, size, most, together):
        monkeypatch.setattr(language_id, "MOST", most)
        monkeypatch.setattr(language_id, "TOGETHER", together)
        out = collections.Counter()
        for batch in language_id._counter(path, ["de", "en", "es"], prob)(batches(size)):
            for lang, piece, n in zip(*(batch[c].to_pylist() for c in ("lang", "piece", "n")), strict=True):
                out[lang, piece] += n
        return out

    for prob in (None, np.random.default_rng(1).random((language_id.pieces_of(path).size, 3)) / 1000):
        whole = counts(prob, 5, 8 << 20, 1 << 20)
        for size, most, together in ((1, 8 << 20, 1 << 20), (1, 8 << 20, 7), (2, 0, 1 << 20)):
            parts = counts(prob, size, most, together)
            assert set(parts) == set(whole) and all(abs(parts[x] - whole[x]) < 1e-9 for x in whole)


def test_language_held_out(spark):
    rows = queries.op2_language_id(spark, SMALL).collect()
    truth = {r.doc_id: r.lang for r in queries.table(spark, SMALL, "documents").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_decoder_restores_words():
    text = " ".join(["you are an idiot and stupid", "this is fine, thanks"] * 300)
    import pyarrow as pa

    counts = np.zeros(toxicity.TRIGRAMS + toxicity.BIGRAMS + toxicity.UNIGRAMS)
    for b in toxicity._count_chars(iter([pa.RecordBatch.from_pydict({"text": [text]})])):
        counts[b.column("bucket").to_numpy()] += b.column("n").to_numpy()
    restore = toxicity.Restorer(toxicity.CharModel(counts))
    assert [restore(t) for t in ("1d10t", "i d i o t", "st*pid", "stuuuupid", "20 3.5", "i.d.i.o.t")] == ["idiot", "idiot", "stupid", "stupid", "20 3.5", "idiot"]


@pytest.mark.parametrize("group", [4096, 1])
def test_suffixes_against_brute_force(spark, group):
    r = random.Random(3)
    base = ["".join(r.choice("ab") for _ in range(r.randint(0, 120))) for _ in range(12)]
    docs = [(i, r.choice(base)[r.randint(0, 30) :] + r.choice(base)) for i in range(40)] + [(102, "a" * 90), (103, "abc" * 40), (104, "é" * 30), (105, "xy" * 50), (106, "xy" * 50)]
    seen = collections.Counter(b[p : p + 20] for _, t in docs for b in [t.encode()] for p in range(len(b) - 19))
    want = []
    for i, t in docs:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 19):
            if seen[b[p : p + 20]] > 1:
                gone[p : p + 20] = True
        want.append((i, len(b), int(gone.sum()), int((np.diff(gone.view(np.int8), prepend=0) == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    got = suffix_dedup.digest(suffix_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"), 20, 8, group))
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("group", [256, 0])
def test_near_duplicates_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(near_dup, "GROUP", group)
    r, docs = random.Random(5), []
    for k in range(12):
        words = r.choices(WORDS, k=120)
        for _ in range(5):
            own = list(words)
            for _ in range(r.randint(0, 5)):
                own[r.randrange(120)] = r.choice(WORDS)
            docs.append((len(docs), " ".join(own)))
    shared = " ".join(r.choices(WORDS, k=60))
    docs += [(len(docs) + i, shared + " " + " ".join(r.choices(WORDS, k=40))) for i in range(8)]
    hashed = [near_dup.word_hashes([t])[0] for _, t in docs]
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if near_dup.jaccard(hashed[i], hashed[j]) >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    got = {x.doc_id: x.class_id for x in near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(docs))] == root


@pytest.mark.parametrize(("group", "chars"), [(1024, 8 << 20), (7, 8 << 20), (1024, 9000)])
def test_outliers_that_resemble_one_member_of_a_large_class(spark, monkeypatch, group, chars):
    """40 edits of a base, and edits of these that are near one of them only; the edits of the base have the smallest ids."""
    monkeypatch.setattr(near_dup, "GROUP", group)
    monkeypatch.setattr(near_dup, "BLOCK_CHARS", chars)
    r = random.Random(7)
    base = r.choices(WORDS, k=200)

    def edit(words, places):
        own = list(words)
        for p in places:
            own[p] = f"x{r.randrange(10**6)}"
        return own

    variants = [edit(base, r.sample(range(5, 195, 10), 2)) for _ in range(40)]
    outliers = [edit(r.choice(variants), r.sample(range(10, 190, 10), 4)) for _ in range(40)]
    docs = [(i, " ".join(w)) for i, w in enumerate(variants + outliers)]
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if near_dup.alike(docs[i][1], docs[j][1]):
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    assert root.count(0) > 60
    got = {x.doc_id: x.class_id for x in near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(docs))] == root


@pytest.mark.parametrize("few", [0, 3, 64])
def test_unmatched_is_the_edit_distance_without_substitution(few):
    r = np.random.default_rng(1)
    for _ in range(60):
        a, b = (r.integers(0, 4, r.integers(0, 12)).astype(np.uint64) for _ in range(2))
        d = np.add.outer(np.arange(len(a) + 1), np.arange(len(b) + 1))
        for i in range(len(a)):
            for j in range(len(b)):
                d[i + 1, j + 1] = d[i, j] if a[i] == b[j] else 1 + min(d[i, j + 1], d[i + 1, j])
        assert near_dup.unmatched(a, b, 30, few) == d[-1, -1]
        assert near_dup.unmatched(a, b, int(d[-1, -1]) - 1, few) is None


def test_near_duplicates_of_repeated_and_null_ids(spark):
    """Each text counts, whatever its doc_id. The two sequences of ab share nearly all shingles and align; they aren't equal."""
    r = random.Random(9)
    a, b, c = (r.choices(WORDS, k=100) for _ in range(3))
    edit = lambda w, p: " ".join([*w[:p], "edited", *w[p + 1 :]])
    thue = [0]
    while len(thue) < 1024:
        thue += [1 - x for x in thue]
    assert near_dup.unmatched(*(near_dup.word_hashes([" ".join(s[x] for x in thue)])[0] for s in ("ab", "ba")), 409, 0) == 164
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, edit(a, 50)), (3, edit(b, 50)), (None, " ".join(c)), (4, edit(c, 50)), (None, "only here"), (5, "Only, HERE!"), (6, " ".join("ab"[x] for x in thue)), (7, " ".join("ba"[x] for x in thue)), (None, "alone"), (8, None), (8, None), (9, " ".join(a))]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, label int")
    got = collections.Counter((x.doc_id, x.class_id) for x in near_dup.near_duplicates(df).collect())
    assert got == collections.Counter([(1, 1), (1, 1), (2, 1), (3, 1), (None, 4), (4, 4), (None, 5), (5, 5), (6, 6), (7, 6), (None, None), (8, 8), (8, 8), (9, 1)])
    kept = sorted((x.label for x in near_dup.one_of_each(df).collect()))
    assert kept[:-1] == [0, 1, 5, 7, 8, 10] and kept[-1] in (11, 12)


def test_leaks_with_an_edit(spark, bench):
    words = LONG.split(" ")[100:140]
    docs = spark.createDataFrame([(1, "x y " + " ".join(words[:38]) + " z"), (2, " ".join(words[:15]) + " q q q q q q " + " ".join(words[20:]))], "doc_id long, text string")
    assert [(r.doc_id, round(r.similarity, 3)) for r in decontaminate.contaminated(docs, bench).collect()] == [(1, round(34 / 38, 3))]


def test_leaks_against_brute_force(spark):
    """Every window of every text, also of rows that repeat a doc_id, against every item; halves swapped, words changed, cut or doubled."""
    r, words = random.Random(3), [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(words, k=r.randint(8, 45)))) for i in range(6)] + [(7, "too short"), (0, "w1 w2 w3 w4 w5 w6 w7 w8 w9")]
    docs = [(None, items[0][1]), (99, None), (98, "")]
    for k in range(60):
        own = r.choice(items)[1].split()
        half = len(own) // 2
        own = [own, own[half:] + own[:half], ["zz" if i == half else w for i, w in enumerate(own)], own[:-2], own + own, own[:half]][k % 6]
        docs.append((k // 2 if k % 10 == 0 else k, " ".join(r.choices(words, k=r.randint(0, 30)) + own + r.choices(words, k=r.randint(0, 30))) if k % 7 else " ".join(own)))

    def shingles(words):
        return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))

    want: dict = {}
    for doc, text in docs:
        words = (text or "").split()
        for item, passage in items if doc is not None else ():
            b = shingles(passage.split())
            for start in range(max(1, len(words) - len(passage.split()) + 1)):
                a = shingles(words[start : start + len(passage.split())])
                both = sum((a & b).values())
                if both and both / (sum(a.values()) + sum(b.values()) - both) >= 0.8:
                    want[doc, item] = max(want.get((doc, item), (0, 0)), (both / (sum(a.values()) + sum(b.values()) - both), -start))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(x.doc_id, x.item_id): (x.similarity, -x.start) for x in decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and len(want) > 15
    clean = decontaminate.decontaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    left = collections.Counter((x.doc_id, x.text) for x in clean.collect())
    assert {d for d, _ in want}.isdisjoint({d for d, _ in left} - {d for d, n in collections.Counter(d for d, _ in docs).items() if n > 1}) and left[None, items[0][1]] == 0


def test_nearest_against_brute_force(spark, monkeypatch):
    for name, value in {"BLOCK": 300, "CHUNK": 4, "FAN": 3}.items():
        monkeypatch.setattr(ann, name, value)
    r = np.random.default_rng(4)
    data = r.standard_normal((1000, 16)).astype(np.float32)
    data[500:520] = data[0]
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] + [1.0] * 15), (2004, [1.0])]
    got = collections.defaultdict(list)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for x in ann.nearest(df).collect():
        got[x.query_id].append((x.rank, x.vec_id, x.score))
    assert sorted(got) == list(range(0, 1000, 100))
    wide = data.astype(float)
    for q, found in got.items():
        d = np.sqrt(ann.exact(wide[q], wide))
        order = [i for i in np.lexsort((np.arange(1000), d)) if i != q][:10]
        assert [(v, s) for _, v, s in sorted(found)] == [(i, d[i]) for i in order]
    assert ann.nearest(df.limit(0)).count() == 0


def test_quotes(spark):
    rows = [(1, 0, "user", "Hello there\nfriend"), (1, 1, "assistant", "> hello  there\n> friend\nHi!"), (1, 2, "user", "> > Hello there\n> > friend\n> Hi!\nok\n>nothing"), (1, 2, "user", None), (None, 0, "x", "> a"), (2, 0, None, "")]
    df = spark.createDataFrame([(*r, 1, "m") for r in rows], "conv_id long, turn long, role string, text string, level int, mark string")
    got = {(r.conv_id, r.turn, r.body): (r.reply_to, r.quote_depth, r.n_quotes, r.n_linked) for r in chat_quotes.linked(df).collect()}
    assert got[1, 1, "Hi!"] == (0, 1, 1, 1) and got[1, 2, "ok"] == (1, 2, 3, 2) and got[1, 2, ""] == (1, 0, 0, 0) and len(got) == 6
    assert chat_quotes.linked(df.limit(0)).count() == 0


def test_quotes_of_parts_of_a_message(spark):
    texts = ["One line.\nAnother line.\n\nSecond  paragraph\nof two lines", "Fine.\nBye", "> another line.\nWhich?", "> One line.\n> Another line.\n\n> second paragraph\n> of two lines\nYes", "> Another line.\n> Bye\n> One line.\nHm", "> Fine.\n> > Second paragraph\nok", "> nowhere\nno"]
    df = spark.createDataFrame([(1, i, "u", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    got = {r.turn: (r.reply_to, r.n_quotes, r.n_linked) for r in chat_quotes.linked(df).collect()}
    assert got == {0: (None, 0, 0), 1: (0, 0, 0), 2: (0, 1, 1), 3: (0, 2, 2), 4: (0, 1, 1), 5: (1, 2, 2), 6: (5, 1, 0)}


def test_threads_of_replies(spark):
    """Roots, depths and positions of a chain, of a branch that quotes an old turn, and of a long conversation."""
    texts = ["First words", "Second words", "> First words\nA branch", "> A branch\nDeeper", "plain"]
    rows = [(1, 10 * i, "u", t) for i, t in enumerate(texts)] + [(2, i, "u", f"t{i}") for i in range(300)] + [(2, 7, "v", "> t2\nagain"), (3, None, "u", "x"), (None, 1, "u", "x")] + [(4, i, "u", "> same\nsame" if i else "same") for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_quotes.linked(df.repartition(7)).collect()
    at = {(r.conv_id, r.turn, r.role): (r.reply_to, r.root, r.depth, r.position) for r in got}
    assert [at[1, 10 * i, "u"] for i in range(5)] == [(None, 0, 0, 0), (0, 0, 1, 1), (0, 0, 1, 2), (20, 0, 2, 3), (30, 0, 3, 4)]
    assert all(at[2, i, "u"] == (i - 1 if i else None, 0, i, i) for i in range(300)) and at[2, 7, "v"] == (2, 0, 3, 7)
    assert at[3, None, "u"] == at[None, 1, "u"] == (None, None, None, None) and len(got) == len(rows)
    assert all(at[4, i, "u"] == (i - 1, 0, i, i) for i in range(1, 200))


def test_quotes_in_a_long_message(spark):
    """20,000 lines in runs of two levels, with a column that has the name of a result."""
    text = "\n".join(("> " if i // 3 % 2 else "") + f"line {i}" for i in range(20_000))
    df = spark.createDataFrame([(1, 0, "u", "line 3\nline 4\nline 5", 1), (1, 1, "u", text, 2)], "conv_id long, turn long, role string, text string, position int")
    got = {r.turn: r for r in chat_quotes.linked(df).collect()}
    assert (got[1].n_quotes, got[1].n_linked, got[1].reply_to, got[0].position) == (3333, 1, 0, 0)


def test_turn_before_a_gap(spark):
    turns = [(c, t) for c in (1, 2, 3) for t in (2, 10, 20, 21, 500)]
    df = spark.createDataFrame([(c, t, "u", "x") for c, t in turns], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r.reply_to for r in chat_quotes.linked(df).collect()}
    assert got == {(c, t): {2: None, 10: 2, 20: 10, 21: 20, 500: 21}[t] for c, t in turns}


def test_quotes_query_against_sql(spark):
    import oracle

    assert oracle.compare(spark, "op8", queries.op8_quotations, queries.ORACLE_SQL["op8_quotations"], SMALL) > 0


def test_hashes_do_not_depend_on_the_place():
    x = flat.PrefixHash(np.arange(50, dtype=np.uint64))
    y = flat.PrefixHash(np.arange(10, 30, dtype=np.uint64))
    assert x.ranges(np.array([12]), np.array([20]))[0] == y.ranges(np.array([2]), np.array([10]))[0] == x.windows(8)[12]




def test_suffix_query_against_brute_force(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in queries.table(spark, SMALL, "documents").collect()}
    seen = collections.Counter(b[p : p + 200] for b in texts.values() for p in range(len(b) - 199))
    removed = 0
    for r in queries.op6_suffix_dedup(spark, SMALL).collect():
        data = texts[r.doc_id]
        gone = np.zeros(len(data) + 1, np.int64)
        for p in range(len(data) - 199):
            if seen[data[p : p + 200]] > 1:
                gone[p] += 1
                gone[p + 200] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        kept = hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(data), gone.sum(), (np.diff(gone.astype(int), prepend=0) == 1).sum(), kept)
        removed += r.n_removed
    assert removed > 1000


def library_ids(spark, kind, end):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.vocabulary(kind))
    return {r.doc_id: [*plain.encode(r.text or "", add_special_tokens=False).ids, end] for r in queries.table(spark, SMALL, "documents").collect()}


def test_token_query_against_the_library(spark):
    ids, start = library_ids(spark, "bytes", 2), 0
    got = {r.doc_id: r for r in queries.op3_token_planes(spark, SMALL).collect()}
    for doc in sorted(ids):
        own = np.array(ids[doc], "<u4")
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)
    assert len(got) == len(ids)


def test_packing_query_against_the_library(spark):
    """Each id lies in exactly one piece; sequences are gapless and at most 2048 long; little is padded."""
    ids, pieces, sequences = library_ids(spark, "words", 1), collections.defaultdict(list), collections.defaultdict(list)
    for r in queries.op10_packing(spark, SMALL).collect():
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(own) == r.length > 0 and r.ids_crc32 == zlib.crc32(own.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, own in ids.items():
        at = 0
        for start, length in sorted(pieces[doc]):
            assert start == at
            at += length
        assert at == len(own)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(map(len, ids.values()))
    assert total / (2048 * len(sequences)) > 0.95


def test_pipeline_against_its_stages(spark):
    """Toxic documents, all but one of each class, and documents with a benchmark passage go; secrets are marked; the rest is packed."""
    import corpus_pipeline

    docs = queries.table(spark, SMALL, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.toxicity(docs, queries.table(spark, SMALL, "labels")).collect() if r.predicted}
    left = docs.filter(~docs.doc_id.isin(list(toxic)))
    hashed = {i: near_dup.word_hashes([t])[0] for i, t in text.items() if i not in toxic}
    root = {i: i for i in hashed}
    for i in sorted(hashed):
        for j in sorted(hashed):
            if j < i and near_dup.jaccard(hashed[i], hashed[j]) >= 0.8 and near_dup.aligned(hashed[i], hashed[j]):
                a, b = sorted((root[i], root[j]))
                root = {k: a if x == b else x for k, x in root.items()}
    leaks = {r.doc_id for r in decontaminate.contaminated(left, queries.table(spark, SMALL, "benchmark")).collect()}
    want = {i for i in root if root[i] == i} - leaks
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in got} == want and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secret_scan", "packing"]
    assert all(sum(r.length for r in got if r.doc_id == i) == next(r.doc_tokens for r in got if r.doc_id == i) for i in want)


def test_pipeline_stages_keep_odd_rows(spark, tmp_path):
    """Null and empty texts, null ids, equal rows and clashing names go through every stage; an empty table gives an empty one."""
    import corpus_pipeline

    rows = [(1, None, "a", 1), (2, "", "b", 2), (None, "some words of a text without an id", "c", 3), (4, "password=abcdef123 and more words here", "d", 4), (4, "password=abcdef123 and more words here", "d", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, start int")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.limit(0), SMALL).count() == 0
        kept[name] = stage(spark, df, SMALL).collect()
    assert [len(kept[n]) for n, _ in corpus_pipeline.STAGES[:4]] == [5, 3, 5, 5] and len({r.doc_id for r in kept["packing"]}) == 4
    assert all(r.text.startswith("[secret]") for r in kept["secret_scan"] if r.doc_id == 4)
