"""Structure repair, packing and importance resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from airloom.llm import importance, packing, structure

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def plain_repair(turns):
    """(cost, audit, repaired, faults) by trying all edits of each row in turn, forwards."""
    seen, rows = set(), []
    for role, text in turns:
        last = re.sub(r"[\x20\x09-\x0D]+$", "", text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
        seen.add((role, text))
        rows.append((role, text, fault))
    best = {"": (0, "", [])}

    def insert():
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                to = NEXT[state]
                offer = (cost + 3, audit + "I", [*out, f"{ROLE[to]}:"])
                best[to] = min(best.get(to, offer), offer)

    for role, text, fault in rows:
        insert()
        after = {}
        for state, (cost, audit, out) in best.items():
            offers = [(state, cost + 4, audit + "D", out)]
            if fault in ("", "truncated"):
                extra, to, first = 3 * (fault == "truncated"), NEXT[state], role[:1]
                offers.append((to, cost + 3 + extra, audit + "R", [*out, f"{ROLE[to]}:{text}"]))
                if first == to or (first == "s" and state == ""):
                    offers.append((first, cost + extra, audit + "K", [*out, f"{role}:{text}"]))
            for to, *offer in offers:
                after[to] = min(after.get(to, tuple(offer)), tuple(offer))
        best = after
    insert()
    return *min(best[s] for s in ("", "a") if s in best), Counter(r[2] for r in rows)


def odd_turns(draw, conv, n):
    said = ["Yes.", "no", " \t", "", "What?", "Really!  ", "cut", "x" * 50 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "usher", None]
    return [(conv, draw.choice([None, *range(n + 2)]), draw.choice(roles), draw.choice([*said, None]), 1) for _ in range(n)]


def order(row):
    role, text = " " if row[2] is None else row[2], " " if row[3] is None else row[3]
    return (row[1] is not None, row[1] or 0, role, hashlib.md5(text.encode()).hexdigest()), role, text


def test_repairs_are_the_cheapest_and_least(spark):
    draw = random.Random(3)
    rows = [r for conv in [None, *range(60)] for r in odd_turns(draw, conv, draw.randrange(1, 9))]
    rows += odd_turns(draw, 99, 300) + [(100, 4, "user", "Again.", 1)] * 40
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int")
    typed = structure.typed(turns)
    made = {r.conv_id: r for r in structure.report(typed, block=7).collect()}
    whole = {r.conv_id: r for r in structure.report(typed).collect()}
    assert made == whole
    edits = defaultdict(list)
    for r in structure.repair(typed, block=5).collect():
        edits[r.conv_id].append(r)
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(order(r))
    assert set(made) == set(groups)
    for conv, said in groups.items():
        said.sort()
        cost, audit, out, faults = plain_repair([s[1:] for s in said])
        r = made[conv]
        assert (r.cost, r.audit) == (cost, audit), conv
        assert r.repaired_sha256 == hashlib.sha256("\n".join(out).encode()).hexdigest()
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults[k] for k in ("blank", "duplicate", "truncated"))
        pairs = zip(said, said[1:])
        assert r.illegal == sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
        numbers = {s[0][1] for s in said if s[0][0]}
        assert r.gaps == (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0)
        mine = sorted(edits[conv], key=lambda e: e.pos)
        assert "".join(e.edit for e in mine) == audit
        assert [f"{e.role}:{e.text}" for e in mine if e.edit != "D"] == out
    assert structure.report(structure.typed(turns.limit(0))).count() == 0
    assert structure.repair(structure.typed(turns.limit(0))).count() == 0


def test_damage_is_seeded_and_keeps_every_conversation(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in [None, *range(40)] for t in (None, 0, 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    hurt = structure.damaged(structure.typed(turns)).collect()
    for r in hurt:
        name = f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}"
        h = zlib.crc32(name.encode()) % 20
        text = {1: "", 2: "One Two"}.get(h, "One. Two!")
        assert (r.n, r.role, r.text) == ({0: 0, 3: 2}.get(h, 1), "user" if h == 4 else "assistant", text)
    gone = structure.damaged(structure.typed(turns)).withColumn("n", structure.F.lit(0).cast("long"))
    made = structure.report(gone).collect()
    assert len(made) == 41
    assert {tuple(r)[1:] for r in made} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_tournament_is_first_fit():
    draw = random.Random(1)
    for n in (1, 2, 7, 64, 300):
        sizes = [draw.randrange(1, 101) for _ in range(n)]
        plain = []
        for i in sorted(range(n), key=lambda i: (-sizes[i], i)):
            for held in plain:
                if sum(sizes[j] for j in held) + sizes[i] <= 100:
                    held.append(i)
                    break
            else:
                plain.append([i])
        assert packing.first_fit_decreasing(sizes, 100) == plain
    assert packing.first_fit_decreasing([], 100) == []
    assert packing.pack_rests([], 64) == []


def test_rests_fill_their_sequences():
    draw = random.Random(2)
    for n in (1, 3, 40, 500):
        sizes = [draw.randrange(1, 64) for _ in range(n)]
        cover = defaultdict(list)
        for items in packing.pack_rests(sizes, 64, 2):
            used = sum(n for *_, n in items)
            assert 62 <= used <= 64 or used & (used - 1) == 0
            for item, at, size in items:
                cover[item].append((at, size))
        for item, size in enumerate(sizes):
            ends = [0]
            for at, part in sorted(cover[item]):
                assert at == ends[-1] and part > 0
                ends.append(at + part)
            assert ends[-1] == size


def test_pieces_make_up_the_documents(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.withColumn("offset", docs.doc_id)
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True  # their strings in a text are ordinary text
    for length, group in ((64, 4), (1024, 1000)):
        pieces = packing.pack(rows, path, public_tokenizers.PATTERN, length=length, group=group).collect()
        want = Counter()
        for r in rows.collect():
            ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 0]
            want[r.doc_id, np.array(ids, "<u4").tobytes()] += 1
        at = defaultdict(list)
        for p in pieces:
            assert len(p.ids) == 4 * p.length
            at[p.sequence_id].append(p)
        padding = 0
        for held in at.values():
            held.sort(key=lambda p: p.offset)
            ends = np.cumsum([p.length for p in held]).tolist()
            assert [p.offset for p in held] == [0, *ends[:-1]] and ends[-1] <= length
            padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else length - ends[-1]
        assert padding <= packing.SLACK * len(at)
        # all rows of one id and length have one text here: each place is covered once by each
        texts = {(key, len(ids) // 4): (ids, n) for (key, ids), n in want.items()}
        covered = defaultdict(Counter)
        for p in pieces:
            ids, _ = texts[p.doc_id, p.doc_tokens]
            assert p.ids == ids[4 * p.start : 4 * (p.start + p.length)]
            covered[p.doc_id, p.doc_tokens].update(range(p.start, p.start + p.length))
        assert covered == {d: {i: n for i in range(d[1])} for d, (_, n) in texts.items()}
    assert packing.pack(rows.limit(0), path, public_tokenizers.PATTERN).count() == 0


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) % 10_000 for r in runs]


def test_features_are_those_of_each_text(docs):
    import pyarrow as pa

    texts = [r.text for r in docs.collect()] + ["Ein Wort", "zwei", "", "é" * 90 + " ÀB " + "q" * 64 + "-" + "r" * 65, None, "0aZ [b` {c"]
    words, owner, bucket = importance.features(pa.array(texts).slice(0))
    for i, text in enumerate(texts):
        w, f = plain_features(text)
        assert words[i] == len(w) and sorted(bucket[owner == i].tolist()) == sorted(f)
    words, owner, bucket = importance.features(pa.array(texts).slice(11, 3))
    assert words.tolist() == [2, 1, 0] and sorted(bucket[owner == 0].tolist()) == sorted(plain_features("ein wort")[1])
    assert importance.features(pa.array([], pa.string()))[0].tolist() == []


def test_drawn_documents_are_the_best(spark, docs):
    draw = random.Random(4)
    more = [(1000 + i, " ".join(f"w{draw.randrange(50)}" for _ in range(draw.randrange(10, 60))), "en", 1.0) for i in range(150)]
    rows = docs.unionByName(spark.createDataFrame(more, docs.schema)).withColumn("rank", docs.fp)
    bench = [" ".join(f"w{i % 9}" for i in range(40)), None, ""]
    target = spark.createDataFrame([(t,) for t in bench], "text string")
    raw, goal = Counter(), Counter()
    for r in rows.collect():
        raw.update(plain_features(r.text)[1])
    for t in bench:
        goal.update(plain_features(t)[1])
    s, t = sum(raw.values()), sum(goal.values())
    want, able = [], []
    for r in rows.collect():
        words, found = plain_features(r.text)
        weight = sum(math.floor(1000 * math.log((goal[b] + 1) * (s + 10_000) / ((raw[b] + 1) * (t + 10_000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want.append((r.doc_id, len(found), weight, score))
        if len(words) >= 20:
            able.append((-score, r.doc_id is None, r.doc_id))
    for percent in (0, 5, 40, 100):
        made = importance.resample(rows, target, percent).collect()
        assert sorted(map(str, want)) == sorted(str(tuple(r)[:4]) for r in made)
        best = sorted((r.rank, -r.score, r.doc_id is None, r.doc_id) for r in made if r["rank"] is not None)
        assert [b[1:] for b in best] == sorted(able)[: len(able) * percent // 100]
        assert [b[0] for b in best] == list(range(1, len(best) + 1))
    assert importance.resample(rows.limit(0), target).count() == 0
    assert importance.resample(rows, target.limit(0)).count() == rows.count()


def test_quickselect_finds_every_place(spark):
    rows = spark.createDataFrame([(i * 37 % 101, None if i % 3 else i) for i in range(101)], "a long, b long")
    key = structure.F.struct("a", structure.F.coalesce("b", structure.F.lit(-1)).alias("b"))
    for k in (1, 2, 50, 100, 101):
        last = importance.kth_key(rows, key, k, pivots=3)
        assert rows.filter(key <= last).count() == k
    assert importance.kth_key(rows, key, 0) is None and importance.kth_key(rows, key, 102) is None
