"""WARC archives, periodic runs and spelling variants against plain versions."""

import base64
import gzip
import hashlib
import io
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stackgrain.llm import periodic_runs, queries, spelling, warc

from .conftest import prose

# --- archives ---

PAGES = [(1, "http://a.example/x y\r\nz", "same"), (2, "http://b.example/", "same"), (3, None, None), (4, "u", ""), (5, "ü", "é\r\n\r\nWARC/1.1\r\n"), (6, "v", "only" * 50_000),
         (7, "w", "same"), (7, "w", "same"), (None, "n", "same"), (None, "n", "no id")]


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, offset long")


def plain_records(rows, least=0):
    """The contract by a loop over all pages."""
    groups = {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for page, _, html in rows:
        own = (html or "").encode()
        keeper = max((p for p in groups[own] if p is not None), default=None)
        again = len(own) >= least and page != keeper
        out.append((page, len(own), base64.b32encode(hashlib.sha1(own).digest()).decode(), "revisit" if again else "response", keeper if again else None))
    return sorted(out, key=str)


def records(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.mark.parametrize(("least", "file_bytes"), [(0, 64 << 20), (0, 1), (5, 1000)])
def test_pages_come_back(spark, least, file_bytes):
    assert records(warc.archive_pages(pages_of(spark, PAGES), least, file_bytes)) == plain_records(PAGES, least)


def test_no_pages(spark):
    assert warc.archive_pages(pages_of(spark, PAGES).where("false")).count() == 0


def test_query_of_pages(spark, tmp_path):
    rows = [(i, f"http://h{i % 3}.example/{i}", prose(i % 9, 30)) for i in range(60)]
    pages_of(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    assert records(queries.op11_warc(spark, str(tmp_path))) == plain_records(rows)


def test_members_are_read_alone_and_sidecars_agree(spark):
    crawl = warc.write_archives(pages_of(spark, PAGES), file_bytes=2000)
    whole = {}
    for r in crawl.collect():
        data = open(r.file.removeprefix("file://"), "rb").read()
        one = zlib.decompressobj(31)
        one.decompress(data)
        assert one.eof and not one.unused_data  # a whole-file stream
        whole[r.file] = gzip.decompress(data)
    index = warc.normalise(crawl)
    again = b""
    for r in index.orderBy("file", "offset").collect():
        with open(r.file.removeprefix("file://"), "rb") as f:
            f.seek(r.offset)
            own = gzip.decompress(f.read(r.length))
        assert own.count(b"WARC-Record-ID") == 1 and r.record_id.encode() in own and own.endswith(b"\r\n\r\n")
        again += own
    assert sorted(again) == sorted(b"".join(whole.values()))  # nothing lost, nothing new
    folder = index.first().file.rpartition("/")[0]
    beside = warc.read_sidecars(spark, folder)
    assert records(warc.read_archives(beside)) == records(warc.read_archives(index)) == plain_records(PAGES)
    assert sorted(map(tuple, beside.collect())) == sorted(map(tuple, index.collect()))


def test_payloads_and_urls(spark):
    got = warc.read_archives(warc.normalise(warc.write_archives(pages_of(spark, PAGES))), payloads=True).collect()
    assert {r.page_id: bytes(r.payload) for r in got if r.record_type == "response" and r.page_id in (4, 5, 6, 7)} == {
        4: b"", 5: PAGES[4][2].encode(), 6: b"only" * 50_000, 7: b"same"}
    assert {r.url for r in got if r.page_id in (1, 3)} == {"http://a.example/x%20y%0D%0Az", "urn:page:3"}
    assert all(r.payload is None for r in got if r.record_type == "revisit")


@pytest.mark.parametrize("form", ["one", "many", "plain"])
def test_any_archive_is_normalised(spark, tmp_path, form):
    data = [warc.record(i, "u", b"x" * i * 400_000, warc.base32_sha1(b"x" * i * 400_000), False, None, "1970-01-01T00:00:00Z") for i in range(4)]
    path = tmp_path / "a.warc.gz"
    path.write_bytes({"one": gzip.compress(b"".join(data)), "many": b"".join(map(gzip.compress, data)), "plain": b"".join(data)}[form])
    index = warc.normalise(spark.createDataFrame([(f"file://{path}",)], "file string"))
    got = warc.read_archives(index).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in got) == [(i, i * 400_000) for i in range(4)]


def test_damage_is_told():
    data = warc.record(1, "u", b"payload", warc.base32_sha1(b"payload"), False, None, "d")
    packed = gzip.compress(data * 3)
    with pytest.raises(EOFError):
        list(warc.split_records(warc.inflated(io.BytesIO(packed[:-12]))))
    with pytest.raises(EOFError):
        list(warc.split_records(iter([data, data[:-10]])))
    with pytest.raises(ValueError, match="not a WARC record"):
        list(warc.split_records(iter([b"HTTP/1.1 200 OK\r\n\r\n"])))
    one_by_one = iter([(data * 2)[i : i + 1] for i in range(2 * len(data))])
    assert [d for _, d in warc.split_records(one_by_one)] == [data, data]


# --- periodic runs ---


def plain_runs(words, least=12):
    """All runs by trying every period at every place."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            n = j - i + q
            own = words[i : i + n]
            if j > i and n >= max(least, 2 * q) and not any(own[e:] == own[:-e] for e in range(1, q)):
                found.append((i, n, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n, own = h // 10, len(words), list(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    said = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


RUN_COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def run_rows(df):
    return sorted((tuple(r[c] for c in RUN_COLUMNS) for r in df.collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4), st.integers(2, 9), st.sampled_from([2, 5, 12]))
def test_runs_equal_every_period_at_every_place(docs, times, least):
    docs = [[str(w).encode() for w in d] for d in docs]
    docs += [d[: len(d) // 2] + d[len(d) // 2 :] * times for d in docs if len(d) < 15]
    assert periodic_runs.runs_of(docs, least) == [plain_runs(d, least) for d in docs]


def test_runs_of_strings_with_many():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 600:
        a, b = b, b + a
    assert periodic_runs.runs_of([b, b[::-1], [b"x"] * 500]) == [plain_runs(b), plain_runs(b[::-1]), [(0, 500, 1)]]


def test_run_query_equals_the_plain_version(spark, tmp_path):
    r = random.Random(3)
    texts = []
    for i in range(250):
        words = prose(i, r.randint(0, 120)).split()
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(words))
            words[at:at] = words[at : at + r.randint(1, 9)] * r.randint(1, 9)
        texts.append((i, r.choice([" ", "\n", "\t  "]).join(words)))
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = run_rows(queries.op12_periodic_runs(spark, str(tmp_path)))
    assert got == sorted((plain_row(*x) for x in texts), key=str)
    assert sum(r[1] > 0 for r in got) > 50


def test_runs_of_awkward_documents(hard, nothing):
    own = [(r.doc_id, r.text) for r in hard.select("doc_id", "text").collect()]
    own = [x for x in own if len(x[1] or "") < 50_000]
    got = periodic_runs.find_runs(hard.where("coalesce(length(text), 0) < 50000"), tails=True)
    assert run_rows(got) == sorted((plain_row(*x) for x in own), key=str)
    assert periodic_runs.find_runs(hard).count() == hard.count()
    empty = periodic_runs.find_runs(nothing)
    assert empty.count() == 0 and empty.columns[:8] == list(RUN_COLUMNS)


# --- spelling variants ---

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes b of a."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(docs):
    n = Counter()
    for doc_id, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if k >= 3 and len(w) >= 5}
    own, form = {w: [x for x in n if near(w, x)] for w in n}, {}
    for w, others in own.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(own[w]), n.get(form[w])))
    return sorted(out, key=str)


def variant_rows(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def test_variants_equal_all_pairs(spark, tmp_path):
    r = random.Random(8)
    letters = "abcé"
    words = ["".join(r.choice(letters) for _ in range(r.randint(4, 9))) for _ in range(150)] + ["aaaaa", "aaaaaa", "aaaaaaa", "aaaaaaaa", "ab" * 20, "ab" * 20 + "a"]
    words += [w[:i] + r.choice(letters) + w[i + r.randint(0, 1) :] for w in words for i in [r.randrange(len(w))]]
    docs = [(i, " ".join(r.choices(words, [1 / (k + 1) for k in range(len(words))], k=400)).replace("ca", "Ca")) for i in range(40)]
    docs += [(40, None), (41, ""), (42, "×÷×÷× ×÷×÷× ×÷×÷×"), (None, "chainé " * 3 + "Éclair éclair"), (42, "aaaaa,aaaaa;aaaab-aaaabĀaaaab")]
    spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, word string").write.parquet(f"{tmp_path}/documents.parquet")
    got = variant_rows(queries.op13_spelling_variants(spark, str(tmp_path)))
    assert got == plain_variants(docs)
    assert sum(x[4] > 0 for x in got) > 100 and sum(x[1] is not None for x in got) > 30


def test_chains_end_at_their_root(spark):
    n = {"aaaaa": 100, "aaaab": 45, "aaabb": 20, "aabbb": 9, "abbbb": 4, "bbbbb": 4, "ccccc": 7}
    docs = spark.createDataFrame([(1, f"{w} " * k) for w, k in n.items()], "doc_id long, text string")
    got = {r.word: (r.form, r.root) for r in spelling.variants(docs, damage=0).collect()}
    assert got["abbbb"] == ("aabbb", "aaaaa") and got["aaaaa"] == (None, "aaaaa") and got["ccccc"] == (None, "ccccc")
    assert got["bbbbb"] == (None, "bbbbb")  # its near word is as frequent only


def test_no_words_are_broadcast(spark, monkeypatch):
    """The tables are far below the broadcast threshold here; their keys pass it long before their file does."""
    plans, plain = [], spelling.stored

    def stored(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name)

    monkeypatch.setattr(spelling, "stored", stored)
    docs = spark.createDataFrame([(1, "aaaaa " * 20 + "aaaab " * 8 + "aaabb " * 3)], "doc_id long, text string")
    got = spelling.variants(docs, damage=0)
    assert sorted((r.word, r.root) for r in got.collect()) == [("aaaaa", "aaaaa"), ("aaaab", "aaaaa"), ("aaabb", "aaaaa")]
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 3
    assert not [p for p in plans if "Broadcast" in p]


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=5, max_size=12), st.integers(0, 12), st.sampled_from("abx"), st.booleans())
def test_one_edit_keeps_a_chunk(word, at, letter, replace):
    at %= len(word) + 1
    other = word[:at] + letter + word[at + replace :]
    if near(word, other):
        short, long = sorted((word, other), key=len)
        ends = {(k, r, last) for k, r, last in spelling.chunk_keys(short)}
        met = [(r, g) for k, r, last in ends for k2, g in spelling.gram_keys(long) if k == k2]
        assert met
        if len(short) < len(long):
            once = [1 for k, r, last in ends for k2, g in spelling.gram_keys(long) if k == k2 and (last or not g.startswith(r))]
            assert len(once) == 1


def test_variants_of_awkward_documents(hard, nothing):
    own = [(r.doc_id, r.text) for r in hard.select("doc_id", "text").collect()]
    short = [x for x in own if len(x[1] or "") < 50_000]
    got = spelling.variants(hard.where("coalesce(length(text), 0) < 50000"))
    assert variant_rows(got) == plain_variants(short)
    assert spelling.variants(nothing).count() == 0
