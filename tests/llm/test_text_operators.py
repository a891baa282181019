"""Chat formatting, mixing, secrets, sharding and leaks on small tables with awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyseq.llm import benchmark_leaks, chat_format, jump_sharding, mixing, secret_ledger
from tallyseq.llm.words import WORD, words

LONG = "word " * 60_000


def test_words_follow_the_pattern():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aB \t\n\x0b\x0c\r\x1c\x85\xa0é中😀|") for _ in range(rng.randint(0, 40)))
        want = re.findall(WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        assert [w.decode() for w in words(text)] == want


def chats(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("parts", F.array(chat_format.text_part(F.col("text")))).withColumn("formatted", F.lit(1))
    return chat_format.format_chats(df)


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<|turn|>x<|end|>", "\\<|", "<\\|", "back\\slash", "", None, "é😀<", "|end|>", LONG]
    rows = [(i, t, r, x) for i, x in enumerate(odd) for t, r in enumerate(["user", "assistant", None, "assis<|tant"])]
    rows += [(99, None, "assistant", "b"), (99, None, "assistant", "a"), (99, 1, "user", "q"), (99, 1, "user", "q"), (None, 0, "assistant", "z")]
    out = {r.conv_id: r for r in chat_format.read_back(chats(spark, rows)).collect()}
    assert set(out) == {r[0] for r in rows}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    for c, turns in by.items():
        turns.sort()
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert out[c].n_turns == len(turns)
        assert out[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (out[c].loss_chars, out[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_controls_never_survive_in_bodies(spark):
    row = chats(spark, [(1, 0, "user", "<|end|></s>[INST]<s>[/INST]")]).first()
    body = row.formatted.split(chat_format.BODY)[1].removesuffix(chat_format.END)
    assert not any(c in body for c in chat_format.CONTROLS)


def test_chat_parts_and_attachments(spark):
    part = lambda kind, **k: (kind, k.get("text"), k.get("ref"), k.get("width"), k.get("height"), k.get("seconds"), k.get("pages"))
    rows = [(1, 0, "user", [part("text", text="see "), part("image", ref="a.png", width=30, height=14), None, part("audio", ref="b.wav", seconds=1.5)]),
            (1, 1, "assistant", [part("document", ref="c.pdf", pages=2), part("text", text="<|image|>"), part("video")]), (2, 0, "user", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_format.PART}>")
    out = {r.conv_id: r for r in chat_format.format_chats(df).collect()}
    assert [(a["kind"], a["ref"], a["tokens"]) for a in out[1].attachments] == [("image", "a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 2048), ("video", None, 0)]
    assert out[1].attachment_tokens == 3 + 38 + 2048 and out[2].attachment_tokens == 0
    assert re.findall(r"<\|(image|audio|document|attachment)\|>", out[1].formatted) == ["image", "audio", "document", "attachment"]
    s = out[1].loss_spans[0]
    assert out[1].formatted[s["start"]:s["end"]] == "<|document|><\\|image|><|attachment|>"


def test_chat_controls_across_parts(spark):
    text = lambda *xs: [("text", x, None, None, None, None, None) for x in xs]
    image = [("image", None, "i", 14, 14, None, None)]
    cases = [text("a<", "|end|>b"), text("</", "s>"), text("<", "", "|turn|>"), text("[", "INST]"), text("x\\", "<|"), text("<") + image + text("|end|>"), text("<\\"), text("<", "\\"), text("a", None, "b")]
    rows = [(i, t, r, p) for i, p in enumerate(cases) for t, r in enumerate(("user", "assistant"))]
    chat = chat_format.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_format.PART}>"))
    out = {r.conv_id: r for r in chat_format.read_back(chat).collect()}
    for i, p in enumerate(cases):
        body = "".join((x[1] or "") if x[0] == "text" else "<|image|>" for x in p)
        assert out[i].n_turns == 2
        assert out[i].loss_sha256 == hashlib.sha256(body.encode()).hexdigest()
        assert out[i].turns_sha256 == hashlib.sha256(f"user\n{body}\nassistant\n{body}\n".encode()).hexdigest()
    for r in chat.collect():
        for body in r.formatted.split(chat_format.BODY)[1:]:
            body = body.split(chat_format.END)[0].replace("<|image|>", " ")
            assert not any(c in body for c in chat_format.CONTROLS)


def test_chat_empty(spark):
    assert chat_format.read_back(chats(spark, [])).count() == 0


def water(sizes, share, cap):
    """(source -> (size, weight)) -> targets by clamping and dealing again."""
    target, left, open_ = {}, share * sum(s for s, _ in sizes.values()), dict(sizes)
    while open_:
        level = left / sum(w for _, w in open_.values())
        full = {k for k, (s, w) in open_.items() if level * w >= cap * s}
        if not full:
            return target | {k: level * w for k, (_, w) in open_.items()}
        for k in full:
            target[k] = cap * open_[k][0]
            left -= target[k]
            del open_[k]
    return target


def test_mixing_targets_and_draws(spark):
    rng = random.Random(3)
    rows = [(i if i % 50 else None, "w " * rng.randint(0, 30), rng.choice(["b", "a", "é", "Z", None, "hot", "hot", "hot"]), "x") for i in range(3000)]
    rows += [(7001, LONG, "a", "x"), (7002, None, "b", "x"), (5, "same", "b", "x"), (5, "same", "b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    out = mixing.mix_sources(df).collect()
    assert len(out) == len(rows)
    size = Counter()
    for _, t, s, _ in rows:
        size[s] += len(words(t))
    order = sorted([s for s in size if s is not None]) + [None]
    want = water({s: (size[s], (5, 2, 1)[i % 3]) for i, s in enumerate(order)}, 1.5, 2.0)
    taken, most = Counter(), Counter()
    for r in out:
        assert r.target == pytest.approx(want[r.source], rel=1e-12) and r.source_size == size[r.source] and 0 <= r.times <= 2
        taken[r.source] += r.times * r.size
        most[r.source] = max(most[r.source], r.size)
    for s in size:
        assert abs(taken[s] - want[s]) <= max(most[s] / 2, 1) + 60  # rows without a key share draws with equal texts
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))
    mixed = mixing.repeat_rows(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.times for r in out)


def test_mixing_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix_sources(spark.createDataFrame([], schema)).count() == 0
    out = mixing.mix_sources(spark.createDataFrame([(1, " ", "a"), (2, None, None)], schema)).collect()
    assert [(r.size, r.target, r.times) for r in out] == [(0, 0.0, 0)] * 2


ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets_of(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_shards_keep_all_columns(spark):
    rows = [(i, f"text {i % 7}", "x", float(i)) for i in range(500)] + [(None, None, None, None), (None, "", "y", 1.0), (3, "text 3", "x", 3.0), (900, LONG, "z", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, k double")
    out = jump_sharding.place_rows(docs)
    assert out.columns == ["doc_id", "text", "k", *jump_sharding.PLACE]
    got, want = out.collect(), jump_sharding.shard_rows(docs).collect()
    assert Counter((r.doc_id, r.text, r.k) for r in got) == Counter((r[0], r[1], r[3]) for r in rows)
    assert Counter((r.doc_id, r.shard, r.slot, r.grown_shard, r.text_crc32) for r in got) == Counter((r.doc_id, r.shard, r.slot, r.grown_shard, r.text_crc32) for r in want)
    assert jump_sharding.place_rows(docs.limit(0)).count() == 0


def test_secrets_match_python(spark):
    rng = random.Random(5)
    bits = ["token=", "Secret: '", 'API_KEY" = "', "password:", "AKIA", "ABCDEFGH0123456789", "deadbeef01", "0123456789abcdef", "é😀", " ", "\n", "shortval", "x.y/z+a_b-c=longer", "secret", "="]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(400)] + ["", None, "token=secret:abcdefghijklmnop", "AKIA" * 9, "a" * 500_000 + " token=abcdefghijkl"]
    texts += texts[:20]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "path long, text string, spans int")
    out = {r.path: [tuple(s) for s in r.spans] for r in secret_ledger.scan_versions(df).collect()}
    assert out == {i: secrets_of(t or "") for i, t in enumerate(texts)}


def test_ledger_scans_only_unseen_blobs(spark, tmp_path):
    path = str(tmp_path / "ledger")
    table = lambda rows: spark.createDataFrame(rows, "path long, text string, blob_id int")
    scanned = lambda: spark.read.parquet(f"{path}/findings").count()
    read = lambda df: sorted((r.path, -1 if r.spans is None else len(r.spans)) for r in df.collect())
    first = table([(1, "token=abcdefghijkl", 0), (2, None, 0), (2, None, 0)])
    assert read(secret_ledger.scan_versions(first, ledger=path)) == [(1, 1), (2, 0), (2, 0)] and scanned() == 2
    # a second run brings the first path's blob under another path: both come out, nothing is scanned again
    assert read(secret_ledger.scan_versions(table([(3, "token=abcdefghijkl", 0)]), ledger=path)) == [(1, 1), (2, 0), (2, 0), (3, 1)] and scanned() == 2
    # the same run again, and a path that changes its text
    assert len(read(secret_ledger.scan_versions(first, ledger=path))) == 4 and scanned() == 2
    assert read(secret_ledger.scan_versions(table([(1, "clean now", 0)]), ledger=path)) == [(1, 0), (1, 1), (2, 0), (2, 0), (3, 1)] and scanned() == 3
    # a retried write leaves every entry twice
    for part in ("findings", "versions"):
        spark.createDataFrame(spark.read.parquet(f"{path}/{part}").collect(), spark.read.parquet(f"{path}/{part}").schema).write.mode("append").parquet(f"{path}/{part}")
    assert read(secret_ledger.findings(spark, path)) == [(1, 0), (1, 1), (2, 0), (2, 0), (3, 1)]
    # another rule version scans what it is given; older blobs are not known to it
    assert read(secret_ledger.scan_versions(first, ledger=path, rule_version="base-2")) == [(1, -1), (1, 1), (2, 0), (2, 0), (3, 1)]
    assert secret_ledger.scan_versions(first.limit(0)).count() == 0
    named = secret_ledger.scan_versions(first.withColumn("v", F.lit("r1")), version="v").first()
    assert named.version == "r1"


def jump(key, n):
    key, b, j = key & (1 << 64) - 1, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_and_slots(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 12345678901, *range(500), None, None, 7, 7]
    df = spark.createDataFrame([(k, None if i % 9 == 0 else f"é{i}", i) for i, k in enumerate(keys)], "doc_id long, text string, slot int")
    out = jump_sharding.shard_rows(df, shards=8, buckets=16).collect()
    assert len(out) == len(keys)
    slots = defaultdict(list)
    for r in out:
        k = r.doc_id or 0
        assert (r.shard, r.grown_shard) == (jump(k, 8), jump(k, 9)) and (r.grown_shard in (r.shard, 8))
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = Counter((len((f"é{i}" if i % 9 else "").encode()) + 1, zlib.crc32((f"é{i}" if i % 9 else "").encode())) for i in range(len(keys)))
    assert Counter((r["size"], r.text_crc32) for r in out) == sizes
    assert jump_sharding.shard_rows(df.limit(0)).count() == 0
    many = spark.range(300).select(jump_sharding.jump_hash(F.col("id"), 5000).alias("s"), "id").collect()
    assert all(r.s == jump(r.id, 5000) for r in many)


@pytest.mark.parametrize("most", [16 << 20, 0])
def test_leaks_match_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(benchmark_leaks, "BLOCK_BYTES", most)  # by broadcast and by shuffle
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 40)))) for i in range(60)] + [(60, None), (61, " "), (None, "lone item text here now"), (0, "w1 w2")]
    docs = []
    for i in range(150):
        w = rng.choices(vocab, k=rng.randint(0, 200))
        if i % 2:
            p = (rng.choice(items)[1] or "").split()
            p = [x if rng.random() > 0.03 else "changed" for x in p]
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper() for x in p]
        docs.append((i, "\t".join(w), "n"))
    docs += [(None, items[3][1], "n"), (500, None, "n"), (501, "", "n"), (502, items[3][1], "n"), (502, items[3][1], "n"), (503, LONG + items[5][1], "n")]
    want = Counter()
    for d, t, _ in docs:
        w = words(t)
        for i, x in items:
            v = words(x)
            n = min(5, len(v))
            own = set(zip(*[v[k:] for k in range(n)])) if v else set()
            got = len(own & set(zip(*[w[k:] for k in range(n)]))) if v else 0
            if own and got >= math.ceil(0.8 * len(own) - 1e-9):
                want[d, i, len(own), got] += 1
    df = spark.createDataFrame(docs, "doc_id long, text string, n_found string")
    it = spark.createDataFrame(items, "item_id long, text string")
    assert Counter(tuple(r)[:4] for r in benchmark_leaks.find_leaks(df, it).collect()) == want
    kept = benchmark_leaks.drop_leaking(df, it)
    bad = {k[0] for k in want}
    assert kept.columns == df.columns and Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _, _ in docs if d not in bad)
    assert benchmark_leaks.find_leaks(df, it.limit(0)).count() == 0 and benchmark_leaks.find_leaks(df.limit(0), it).count() == 0


def test_leaks_in_blocks(spark, monkeypatch):
    it = spark.createDataFrame([(i, f"item number {i} has these words") for i in range(30)], "item_id long, text string")
    df = spark.createDataFrame([(i, f"see item number {i} has these words now") for i in range(40)], "doc_id long, text string")
    monkeypatch.setattr(benchmark_leaks, "BLOCK_BYTES", 200)
    assert {(r.doc_id, r.item_id) for r in benchmark_leaks.find_leaks(df, it).collect()} == {(i, i) for i in range(30)}
