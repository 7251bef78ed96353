"""Chat formatting, archives and decontamination against SQL and plain versions."""

import base64
import gzip
import hashlib
import math
import random
import re
from pathlib import Path

import pytest
from compare import check_engine, difference

from airloom.llm import chat, decontaminate, simhash, warc
from airloom.llm.queries import QUERIES, SQL
from airloom.llm.shared import shared_folder, stored

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_its_sql(spark, name):
    rows = QUERIES[name](spark, SF)
    result = check_engine(SF).execute(SQL[name])
    assert sorted(rows.columns) == sorted(d[0] for d in result.description)
    ordered = rows.select([d[0] for d in result.description]).collect()
    assert ordered and difference([tuple(r) for r in ordered], result.fetchall(), rows.columns) is None


def test_snapshots_collapse_and_odd_turns(spark):
    rows = [
        (1, 0, "user", "hi"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"),
        (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", "bye"), (3, 2, "user", "bye"),
        (4, 0, "user", "hi"), (4, 1, "assistant", "hello"), (4, 2, "user", "bye"),
        (5, 0, "assistant", "hi"),
        (6, None, None, None), (6, 1, "user", ""),
        (None, 0, "user", "hi"),
    ] + [(7, i, "user", f"turn {i}") for i in range(600)] + [(8, i, "user", f"turn {i}") for i in range(599)]
    turns = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, pos int")
    made = {r.conv_id: r for r in chat.format_chats(turns).collect()}
    assert sorted(made) == [3, 5, 6, 7]
    assert made[3].chat == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n<|im_start|>user\nbye<|im_end|>\n"
    assert made[6].chat == "<|im_start|>user\n<|im_end|>\n" * 2 and made[7].n_turns == 600
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_archives_round_trip(spark, tmp_path):
    big = "<p>é</p>" * 60_000
    rows = [
        (5, "http://a/", big), (3, "http://b/ x\r\n", big), (9, None, "x"), (1, "http://c/", None), (2, "http://c/", ""),
        (4, "http://d/", "y\r\n\r\nWARC/1.1\r\n"), (None, "http://e/", big), (3, "http://b/", big), (7, "http://b/", "short"),
        (8, "http://b/", "short"),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, data int")
    folder = shared_folder(spark)
    Path(folder.removeprefix("file://")).mkdir(parents=True)
    chunks = warc.chunked(warc.typed(pages, min_bytes=6))
    assert chunks.filter("page_id = 3").count() == 2 * 9
    archives = warc.write(chunks, folder).collect()
    listed = spark.createDataFrame([(a.file,) for a in archives], "file string")
    assert sum(a.records for a in archives) == len(rows)
    back = warc.read(listed, folder).collect()
    last = [r for r in back if r.last]
    assert len(last) == len(rows)
    types = {(r.page_id, r.record_type, r.refers_to) for r in last}
    assert types == {(i, "response", None) for i in (3, 9, 1, 2, 4, None, 7, 8)} | {(5, "revisit", 3)}
    text = {i: (h or "").encode() for i, _, h in rows}
    for r in last:
        assert r.payload_bytes == len(text[r.page_id])
        assert base64.b32decode(r.payload_digest) == hashlib.sha1(text[r.page_id]).digest()
    parts = sorted((r.chunk_no, bytes(r.data)) for r in back if r.page_id is None)
    assert b"".join(p for _, p in parts) == big.encode() and len(parts) == 9
    raw = b"".join(gzip.open(a.file).read() for a in archives)
    assert raw.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows) and b"http://b/%20x%0D%0A" in raw
    same = {r.page_id: r.record_type for r in warc.write_and_read(pages).collect()}
    assert same[8] == "revisit" and same[7] == "response" and same[2] == "revisit"
    assert warc.write_and_read(pages.limit(0)).count() == 0


def test_overlaps_tolerate_substitutions(spark):
    item = " ".join(f"alpha{i} beta{i}" for i in range(15))
    words = item.split()
    swapped = [w if i % 8 != 3 else "other" for i, w in enumerate(words)]
    filler = " ".join(f"noise{i}" for i in range(40))
    docs = [
        (1, f"{filler} {item.upper()}! {filler}"),
        (2, f"{filler} {' '.join(swapped)}"),
        (3, filler),
        (4, " ".join(words[5:20])),
        (5, " ".join(words[5:13])),
        (6, "one two three, four five"),
        (7, None), (8, ""), (None, item), (9, " ".join(swapped[:9])),
    ]
    docs = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item int")
    bench = [(1, item), (1, item), (2, "One two THREE four five"), (3, None), (4, "a b"), (None, item)]
    bench = spark.createDataFrame(bench, "item_id long, text string")
    made = {(r.doc_id, r.item_id): (r.matched, r.item_tokens) for r in decontaminate.overlaps(docs, bench).collect()}
    assert set(made) == {(1, 1), (2, 1), (4, 1), (6, 2), (None, 1)}
    assert made[1, 1] == (30, 30) and made[2, 1] == (26, 30) and made[4, 1] == (15, 30)
    clean = decontaminate.keep_clean(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 5, 7, 8, 9]
    assert decontaminate.keep_clean(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.overlaps(docs.limit(0), bench).count() == 0


def every_overlap(docs, bench):
    """Pairs by comparing all diagonals, without seeds."""
    found = {}
    for key, text in docs:
        words = re.findall(r"[^\W_]+", text.lower())
        for item, item_text in bench:
            mine = re.findall(r"[^\W_]+", item_text.lower())
            for d in range(1 - len(mine), len(words)):
                here = best = matched = 0
                for j in range(max(0, -d), min(len(mine), len(words) - d)):
                    equal = mine[j] == words[j + d]
                    here = max(here + (1 if equal else -2), 0)
                    best, matched = max(best, here), matched + equal
                if best >= 13 or matched >= 0.7 * len(mine):
                    found[key, item] = max(matched, found.get((key, item), (0,))[0]), len(mine)
    return found


def test_no_accepted_overlap_is_missed(spark):
    draw = random.Random(5)
    lengths = [*range(5, 40), 45, 52, 59, 60, 75]
    bench = [(n, " ".join(f"w{draw.randrange(400)}" for _ in range(n))) for n in lengths]
    docs = []
    for n, text in bench:
        words, most = text.split(), n - math.ceil(0.7 * n)
        swaps = [draw.sample(range(n), k) for k in {1, most - 1, most, most, most, most + 1} if k > 0]
        # differences set evenly leave the shortest runs
        swaps += [[n * (k + 1) // (most + 1) - (k + 1 == most + 1) for k in range(most)]]
        made = [[f"x{i}" if i in s else w for i, w in enumerate(words)] for s in swaps]
        # a part only: a stretch with a difference after every run of three or so
        made += [[f"y{i}" if i % 6 == 5 else w for i, w in enumerate(words)][n // 3 :], words[-13:], words[:12]]
        docs += [" ".join(["left"] * draw.randrange(3) + m + ["right"] * draw.randrange(3)) for m in made]
    docs = list(enumerate(docs))
    want = every_overlap(docs, bench)
    made = decontaminate.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    )
    assert len(want) > 4 * len(bench)
    assert {(r.doc_id, r.item_id): (r.matched, r.item_tokens) for r in made.collect()} == want


def test_seeds_above_the_broadcast_bound_are_shuffled(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want, plans = set(map(tuple, decontaminate.overlaps(docs, bench).collect())), []

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 1)
    monkeypatch.setattr(decontaminate, "stored", noted)
    assert set(map(tuple, decontaminate.overlaps(docs, bench).collect())) == want and want
    assert "SortMergeJoin" in plans[1] and "Broadcast" not in plans[1]


def test_every_pattern_spoils_a_tile_less(spark):
    """For each length: the widest sets of tiles still hold one more than the differences can spoil."""
    items = spark.createDataFrame([(n, [str(i) for i in range(n)]) for n in range(5, 151)], "item long, tokens array<string>")
    cut = {}
    for r in decontaminate.tiles(items).collect():
        cut.setdefault(r.item, []).append((r.place - 1, r.place - 1 + r.width))
    for n, parts in cut.items():
        parts.sort()
        assert parts[0][0] == 0 and parts[-1][1] <= n and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        assert len(parts) > n - math.ceil(0.7 * n)
        for size in range(13, n + 1):
            held = min(sum(a >= s and b <= s + size for a, b in parts) for s in range(n - size + 1))
            assert held > (size - 13) // 3


def test_rows_are_judged_by_their_own_text(spark):
    a, b, c = (" ".join(f"{name}{i * i}" for i in range(40)) for name in ("ash", "birch", "cedar"))
    rows = [(3, a), (5, a), (5, b), (None, c), (None, c), (None, a), (None, None), (6, b), (7, c + " end"), (7, c + " end")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")
    kept = simhash.keep_one(docs.filter("doc_id IS NULL OR doc_id < 7"))
    assert kept.columns == docs.columns
    want = [(3, a), (5, b), (None, c), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    bench = spark.createDataFrame([(1, a)], "item_id long, text string")
    clean = decontaminate.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    want = [r for r in rows if r[1] != a]
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr) == sorted(want, key=repr)
