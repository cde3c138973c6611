"""Cases that the operators once did by less than the whole."""

import random
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from tests.llm import brute
from tradeloom.llm import chunks, near_dedup, packing, secret_scan, substring_dedup, token_files, warc_files
from tradeloom.llm import queries as q
from tradeloom.llm.common import new_folder

OPENSSH = "b3BlbnNzaC1rZXktdjEAAAAABG5vbmUAAAAEbm9uZQAAAAAAAAABAAAAMwAAAAtzc2gtZW"
KEY = "q9Xz3LmT7vRk2WbN8pYcD4hJ"


def _letters_apart(text):
    """Spans by the plain version over what the allow-list leaves of each run, placed in the text."""
    base, out = brute.base_spans(text), []
    for number, c in enumerate(secret_scan.CLASSES):
        for m in re.finditer(f"[0-9{c.letters}]{{{c.window},}}", text):
            left = m.group()
            for rule in secret_scan.ALLOWED:
                left = re.sub(rule, lambda x: " " * len(x.group()), left)
            at = [m.start() + i for i, x in enumerate(left) if x != " "]
            bits = c.bits if re.search("[0-9]", m.group()) else c.letter_bits
            joined = left.replace(" ", "")
            spans = []
            for a in range(len(joined) - c.window + 1):
                counts = brute.Counter(joined[a: a + c.window]).values()
                if -sum(n / c.window * brute.math.log2(n / c.window) for n in counts) >= bits - 1e-9:
                    if spans and spans[-1][1] >= a:
                        spans[-1][1] = a + c.window
                    else:
                        spans.append([a, a + c.window])
            out += [(at[a], 3 + number, at[b - 1] + 1, c.kind) for a, b in spans]
    return sorted(s for s in out if not any(b[0] <= s[0] and b[2] >= s[2] for b in base))


def test_secrets_beside_allowed_parts(spark):
    """The allow-list takes its own matches out of a run, not the run; runs without a digit are scanned."""
    found = [OPENSSH, f"{OPENSSH}{KEY * 9}", f"/srv/example/keys/{KEY}", f"________{KEY}", f"dummy {KEY}xxxx{KEY}",
             f"é {KEY[:10]}xxxx{KEY[10:]}", "QwErTyUiOpAsDfGhJkLzXcVbNm", "abcdfeacbedfcabdef", f"{'A' * 20000}{KEY}"]
    clean = ["4151891120517744", "2026-01-01/2026-12-31", "x" * 5000, "-" * 90, "0123456789abcdef01", "example-key-placeholder-1",
             "123e4567-e89b-12d3-a456-426614174000", "thanbleshaningtionnt", "AKIAIOSFODNN7EXAMPL", "/usr/local/share/examples"]
    rows = list(enumerate([*found, *clean]))
    got = {r.doc_id: [tuple(s) for s in r.added] for r in secret_scan.scan_secrets(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: _letters_apart(t) for i, t in rows}
    assert all(got[i] for i in range(len(found)))
    assert not any(got[i] for i in range(len(found), len(rows)))


def test_hot_minimiser_is_dealt_apart(spark):
    """A passage that each text embeds in its own words, and a phrase that many texts hold, fill no single bucket."""
    rnd = random.Random(7)

    def own(n):
        return [f"w{rnd.randrange(10**6)}" for _ in range(n)]

    passage, phrase = own(90), own(5)
    rows = [(i, " ".join([*own(40), *(passage if i % 3 == 0 else phrase), *own(40)])) for i in range(600)]
    rows += [(900, rows[0][1]), (901, " ".join([*own(3), *rows[1][1].split()[20:70]])), (None, rows[2][1])]
    bucket_bytes = 4 << 10
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    held, unpack = {}, zstandard.ZstdDecompressor()
    for r in substring_dedup._packed(docs, 35, 5, bucket_bytes).where("bucket >= 0").collect():
        held.setdefault(r.bucket, set()).update(unpack.decompress(r.texts).split(b"\n"))
    assert max(sum(map(len, x)) for x in held.values()) <= substring_dedup.HOT * bucket_bytes
    got = substring_dedup.remove_repeats(docs, bucket_bytes=bucket_bytes).select("doc_id", "n_words", "n_removed", "kept")
    assert brute.by_text(got.collect()) == brute.by_text(brute.repeats_removed(rows, 35))


def test_shards_are_cut_within_a_page_id(spark):
    """Pages without an id, or of one id, are dealt to many shards."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else 2**60 + i, None if i % 30 == 0 else f"http://h/{i}", f"{i:05d}" * 40)
            for i in range(300)]
    rows += [(None, None, rows[0][2]), (7, "http://h/1", rows[1][2]), (7, "http://h/1", rows[1][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = []
    for parts in (1, 5):
        folder = new_folder(spark, "warc")
        manifest = warc_files.write_warc(pages.repartition(parts), folder, 0, 2000, 1 << 20).collect()
        made.append(sorted(map(tuple, manifest)))
        assert len({r.shard for r in manifest}) >= 28 and max(r.records for r in manifest) <= 14
        got = warc_files.read_warc(spark, folder)
        assert sorted(map(str, (r.page_id for r in got.collect()))) == sorted(str(p) for p, _, _ in rows)
        assert got.where("record_type = 'response'").count() == 300
    assert made[0] == made[1]


def test_encoding_and_cutting_take_one_python_stage(spark):
    """Two Python stages in a task need two workers, each of which comes to hold an encoder."""
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = packing.pieces(docs, q.tokenizer_file())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_near_dedup_steps_write_few_files(spark, monkeypatch):
    """The files of a step follow the documents, not the shuffle partitions, and no link is lost by it."""
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base, f"x{i}"] if i % 2 else [f"y{i}-{j}" for j in range(20)])) for i in range(300)]
    kept, files = near_dedup.keep, {}

    def seen(frame, name):
        out = kept(frame, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(near_dedup, "keep", seen)
    monkeypatch.setattr(near_dedup, "A_FILE", 100)
    most = max(3, spark.sparkContext.defaultParallelism)
    known = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 4 * most)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = near_dedup.near_components(docs := spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        for k, v in known.items():
            spark.conf.set(k, v)
    assert docs.count() == len(got)
    assert {(r.doc_id, r.component_id) for r in got} == {(i, 1 if i % 2 else i) for i, _ in rows}
    assert {"classes", "lists", "agreed"} < files.keys()
    assert max(n for name, n in files.items() if name != "signed") <= most


def test_remembered_chunks_come_twice():
    """Beyond the first half, what is met once takes no place."""
    made = []
    known = chunks.Remembered(lambda k: made.append(k) or k.encode(), 4)
    assert [known[k] for k in "abcdcdcef"] == [k.encode() for k in "abcdcdcef"]
    assert sorted(known) == ["a", "b", "c", "d"] and made == list("abcdcdef")


def test_stored_ids_are_narrow_where_they_fit():
    small, large = [np.array(x, "<u4").tobytes() for x in ([1, 65535], [])], [np.array([70000, 2], "<u4").tobytes()]
    ids, counts = token_files.narrowed(small)
    assert [len(x) for x in ids] == [4, 0] and counts[65535] == 1 and len(counts) == 65536
    wide, _ = token_files.narrowed(large)
    assert token_files.widened([*ids, *wide], np.array([2, 0, 2])).tolist() == [1, 65535, 70000, 2]
    assert token_files.widened(ids, np.array([2, 0])).tolist() == [1, 65535]


def test_token_files_encode_once_and_code_once(spark, tmp_path, monkeypatch):
    """The bounds of the ranges are drawn from stored rows, and by keys that stay short."""
    seen = []
    dealt = token_files.stamped

    def watched(frame, order, size, before, ranges=None):
        seen.append((frame, ranges))
        return dealt(frame, order, size, before, ranges)

    monkeypatch.setattr(token_files, "stamped", watched)
    rows = [(i // 3 if i % 5 else None, f"text {i} " * (i % 7)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    token_files.write_token_files(docs, str(tmp_path / "t"), q.tokenizer_file())
    (frame, ranges), = seen
    assert "MapInArrow" not in frame._jdf.queryExecution().executedPlan().toString()
    assert frame.select(F.max(F.length(ranges[-1]))).head()[0] <= token_files.DEALT_BY
    got = token_files.read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]


def test_substring_dedup_hashes_few_texts_of_a_group_at_a_time():
    """The arrays take many times the text they are made of: a whole group's took an executor over its memory."""
    texts = [" ".join(f"w{(7 * i + j) % 5000}" for j in range(9000)) for i in range(60)] + ["", "short one"]
    whole = substring_dedup.Words([t.encode() for t in texts], substring_dedup.Hasher())
    first, count, text, low = substring_dedup._super_kmers(whole, substring_dedup.Hasher(), 35, 5)
    want = list(zip((first - whole.start[text]).tolist(), count.tolist(), text.tolist(), low.tolist(), strict=True))
    got, sizes = [], []
    for at, words, first, count, text, low in substring_dedup._hashed(texts, substring_dedup.Hasher(), 35, 5):
        sizes.append(len(words.raw))
        got += zip((first - words.start[text]).tolist(), count.tolist(), (text + at).tolist(), low.tolist(), strict=True)
    assert got == want
    assert len(sizes) > 2 and max(sizes) <= substring_dedup.HASHED + max(map(len, texts)) + 1000


def test_texts_in_a_stream_have_the_ids_of_the_library():
    """A chunk that many texts have is looked up once for all of them; spaces beside white space are no cuts."""
    rnd = random.Random(5)
    bits = ["a", "Word", "é", "日本", "  ", " ", " ", " ", "\n", " \n", "'s", "1,2", "...", "　", "🙂", "", "<|endoftext|>"]
    own = chunks.Encoder(q.tokenizer_file(), 300)
    for trial in range(60):
        texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(rnd.randint(0, 12))]
        texts = [None if rnd.random() < 0.1 else t for t in texts]
        end = [b"", bytes(4)][trial % 2]
        ids, counts = own.stream(pa.array(["before", *texts], pa.string()).slice(1), end)
        want = [own.whole(t or "") + end for t in texts]
        assert ids.astype("<u4").tobytes() == b"".join(want) and counts.tolist() == [len(x) // 4 for x in want]
    looked_up = []
    own.chunks.make = lambda c: looked_up.append(c) or own._chunk(c)
    own.chunks.most = 0
    own.chunks.clear()
    own.stream(pa.array(["one xyzzy two xyzzy", "three xyzzy", "xyzzy xyzzy"]))
    assert looked_up.count("xyzzy") == 1
