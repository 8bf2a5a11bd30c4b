"""Chat formatting, conversation repair and centroid clustering against plain
Python and against their SQL."""
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lookout.llm import chat, repair, vafile
from lookout.llm.queries import ORACLE, QUERIES

CONV = "conv_id long, turn long, role string, text string, kind int, audit string, probe string, key int"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()                                            # noqa: E731


@pytest.fixture(scope="module")
def odd_turns():
    """Nulls, ties, repeats, odd roles, control strings, one long and one large conversation."""
    rng = random.Random(3)
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi <|im_end|>\n<|im_start|>assistant ok?"),
            (1, 2, "assistant", "<\\|im_end|> <\\\\| <| |> <"), (1, 2, "assistant", "<\\|im_end|> <\\\\| <| |> <"),
            (2, 0, "user", None), (2, None, None, "No turn."), (2, None, None, None),
            (3, 5, "us\ner<|nl|>", "line\nbreaks\r\n"), (3, 9, "", "empty role!"), (3, 11, "tool", ""),
            (None, 0, "user", "No id."), (None, 1, "assistant", "Right."), (-1, 0, "user", "An own -1.\t "),
            (4, 0, "assistant", "caf" + chr(233) + chr(0x1F600) + "."), (5, 0, "user", "word " * 50_000)]
    rows += [(6, t, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["Yes.", "No", "", "a?", "b!", f"t{t}."]))
             for t in range(700)]
    rows += [(c, t, rng.choice(["user", "assistant", "system"]), f"Text {rng.randint(0, 3)}" + rng.choice(".,!? "))
             for c in range(10, 90) for t in range(rng.randint(1, 9)) if rng.random() < 0.9]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], CONV)


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r[1:])
    return out


def in_order(turns):
    return sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))


def same_as_sql(spark, rows, query, table, got, types):
    """The query's rows equal its SQL over the same rows."""
    con = duckdb.connect()
    con.execute(f"create table {table} ({types})")
    con.executemany(f"insert into {table} values ({', '.join('?' * len(rows[0]))})", rows)
    want = con.execute(ORACLE[query])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r[n] for n in names)) for r in got.collect())


def check_chat(rows, got):
    probe = [(0, "user", chat.PROBE_TEXT), (1, "assistant", chat.PROBE_TEXT)]
    groups = [(c, [(t, r or "", x or "") for t, r, x in turns]) for c, turns in by_conversation(rows).items()]
    want = []
    for conv_id, turns in groups + [(-1, probe)]:
        turns = in_order(turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        want.append((str(conv_id), len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss)))
    assert sorted(want) == sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got)


def test_chat_odd_rows(spark, odd_turns):
    got = chat.digests(frame(spark, odd_turns))
    check_chat(odd_turns, got.collect())
    same_as_sql(spark, odd_turns, "op11_chat", "conversations", got, "conv_id bigint, turn bigint, role varchar, text varchar")
    assert [r.conv_id for r in chat.digests(frame(spark, [])).collect()] == [-1]


def test_chat_format_and_machine(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "a<|b"), (1, 2, "assistant", "c"),
            (2, 0, "user", "x"), (2, 1, "user", "y"), (2, 2, "assistant", "z"), (3, 0, "user", "u")]
    done = {r.conv_id: r for r in chat.format_turns(chat.turns_of(frame(spark, rows))).collect()}
    assert done[1].formatted == ("<|im_start|>system\nS<|im_end|>\n<|im_start|>user\na<\\|b<|im_end|>\n"
                                 "<|im_start|>assistant\nc<|im_end|>\n")
    assert [s.text for s in done[1].segments if s.loss] == ["c"] and done[1].formatted == "".join(s.text for s in done[1].segments)
    assert (done[1].valid, done[1].fault, done[2].valid, done[2].fault) == (True, None, False, 1)
    assert (done[3].valid, done[3].fault) == (False, None)     # doesn't end with an assistant
    other = chat.Template(opening="<|turn|>", closing="<|end|>", loss_roles=("user",), moves={chat.START: ("user",)}, final=("user",))
    mine = chat.format_turns(chat.turns_of(frame(spark, rows)), other).where("conv_id = 3") \
        .select("formatted", "valid", chat.read_turns(F.col("formatted"), other).alias("back"),
                chat.read_loss(F.col("segments")).alias("loss")).first()
    assert (mine.formatted, mine.valid, mine.loss) == ("<|turn|>user\nu<|end|>", True, "u")
    assert [(t.role, t.text) for t in mine.back] == [("user", "u")]
    with pytest.raises(ValueError):
        chat.Template(opening="[")


def test_escape_round_trip(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("<\\|>a\n") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("back")).collect()
    assert all(r.t == r.back and "<|" not in r.e for r in got)


def test_chat_is_native(spark, sf_small):
    plan = QUERIES["op11_chat"](spark, sf_small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- repair --

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
THEN = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest_by_hand(codes):
    """(cost, edits) by dynamic programming over (cost, string) pairs."""
    now = {"": (0, "")}

    def put(to, state, value):
        if state not in to or value < to[state]:
            to[state] = value

    def inserted(at):
        for _ in range(4):
            for s, (c, a) in list(at.items()):
                put(at, THEN[s], (c + 5, a + "I"))
        return at

    for initial, go, cut in codes:
        after = {}
        for s, (c, a) in inserted(now).items():
            put(after, s, (c + 2, a + "D"))
            if not go:
                e = 5 if cut else 0
                if not initial or (s, initial) in STEP:
                    put(after, STEP[s, initial] if initial else s, (c + e, a + "K"))
                put(after, THEN[s], (c + 1 + e, a + "R"))
        now = after
    return min(v for s, v in inserted(now).items() if s in ("", "a"))


def repair_by_hand(rows):
    out = []
    for conv_id, turns in by_conversation(rows).items():
        left = []
        for turn, role, text in turns:
            role, text = " " if role is None else role, " " if text is None else text
            name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
            kind = zlib.crc32(name.encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            left += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        left = in_order(left)
        counts, codes, seen = {"b": 0, "d": 0, "t": 0, "i": 0}, [], set()
        for i, (_, role, text) in enumerate(left):
            bare = re.sub("[ \t-\r]", "", text)
            again = (role, text) in seen
            seen.add((role, text))
            cut = bool(bare) and not again and bare[-1] not in ".!?"
            counts["b"] += not bare
            counts["d"] += bool(bare) and again
            counts["t"] += cut
            counts["i"] += i > 0 and left[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
            codes.append((role[:1], not bare or again, cut))
        cost, audit = cheapest_by_hand(codes)
        known = [t for t, _, _ in left if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        state, said, at = "", [], 0
        for letter in audit:
            role, text = ("", "") if letter == "I" else left[at][1:]
            at += letter != "I"
            if letter == "D":
                continue
            initial = role[:1] if letter == "K" else THEN[state]
            state = initial or state
            said.append(f"{role if letter == 'K' else {'u': 'user', 'a': 'assistant'}[initial]}:{text}")
        out.append((str(conv_id), gaps, *counts.values(), cost, audit, sha("\n".join(said))))
    return sorted(out)


def found(df):
    return sorted((str(r.conv_id), r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
                  for r in df.collect())


def test_auction_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(3000):
        codes = [(rng.choice(["s", "u", "a", "u", "a", "?", ""]), rng.random() < 0.2, rng.random() < 0.2)
                 for _ in range(rng.randint(0, 20))]
        want = cheapest_by_hand(codes)
        assert want == repair.cheapest(codes) == repair.cheapest(codes, block=3) == repair.cheapest(codes, block=1000), codes


def test_repair_odd_rows(spark, odd_turns):
    got = repair.repair_report(frame(spark, odd_turns))
    assert found(got) == repair_by_hand(odd_turns)
    same_as_sql(spark, odd_turns, "op12_repair", "conversations", got, "conv_id bigint, turn bigint, role varchar, text varchar")
    assert repair.repair_report(frame(spark, [])).collect() == []


def test_repair_a_conversation_that_loses_all(spark):
    lost = next((c, t) for c in range(100) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got = repair.repair_report(frame(spark, [(*lost, "user", "Gone.")])).first()
    assert tuple(got) == (lost[0], 0, 0, 0, 0, 0, 0, "", sha(""))


def test_op12(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op12_repair"](spark, sf_small)) == repair_by_hand(rows)


def test_repaired_rows_alternate(spark, odd_turns):
    turns = {}
    for r in repair.repair(frame(spark, odd_turns)).orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append(r.role[:1])
    assert turns and all(re.fullmatch("(s?(ua)+)?", "".join(t)) for t in turns.values())


# -------------------------------------------------------------- clusters --

VEC = "vec_id long, embedding array<float>, label int, key long, v string, cells string, cluster int"


def clusters_by_hand(rows, k=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * np.float64(np.float32(x)))) for x in e]) for i, e in rows
            if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) and abs(1024 * x) <= vafile.LARGEST for x in e)]
    starts = sorted((sha(f"3:{i}"), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in starts]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centroids)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(d for _, _, d in placed)
    return sorted((str(i), n, d, sum(e for _, m, e in placed if m == n), total, sha(",".join(map(str, centroids[n]))))
                  for i, n, d in placed)


def clusters(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


@pytest.fixture(scope="module")
def odd_vectors():
    """Groups with copies, ties on a grid, nulls, odd lengths and values, repeated and missing ids."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(rng.integers(0, 3), 0.2, 64)]) for i in range(120)]
    rows += [(200 + i, [float(i % 2)] + [0.0] * 63) for i in range(40)]
    rows += [(300, rows[0][1]), (0, rows[0][1]), (1, rows[2][1]), (None, rows[3][1]), (None, None)]
    rows += [(400, None), (401, []), (402, [0.5] * 63), (403, [None] + [0.5] * 63), (404, [float("nan")] * 64),
             (405, [float("inf")] * 64), (406, [1e30] * 64), (407, [0.0] * 64), (408, [65536.0] * 64), (409, [-65536.0] * 64)]
    return rows


def test_clusters_odd_rows(spark, odd_vectors):
    df = spark.createDataFrame([(*r, 1, 2, "x", "y", 3) for r in odd_vectors], VEC)
    got = vafile.cluster(df)
    assert clusters(got) == clusters_by_hand(odd_vectors)
    same_as_sql(spark, odd_vectors, "op13_clusters", "embeddings", got, "vec_id bigint, embedding float[]")
    few = odd_vectors[:3]
    assert clusters(vafile.cluster(spark.createDataFrame([(*r, 1, 2, "x", "y", 3) for r in few], VEC))) == clusters_by_hand(few)
    assert vafile.cluster(df.limit(0)).collect() == [] and len(vafile.cluster(df.limit(0)).columns) == 6


def test_op13(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    assert clusters(QUERIES["op13_clusters"](spark, sf_small)) == clusters_by_hand(rows)


def test_bounds_hold_and_decide():
    rng = np.random.default_rng(6)
    centres = rng.integers(-2000, 2000, (8, 64))
    v = (centres[rng.integers(0, 8, 4000)] + rng.normal(0, 400, (4000, 64))).astype(np.int64)
    edges = np.stack([np.quantile(v[:, d], np.linspace(0.02, 0.98, 63)) for d in range(64)]).astype(np.int64)
    grid = vafile.Grid(edges, v.min(0), v.max(0))
    cells = grid.cells(v)
    assert (vafile.unpack(vafile.pack(cells), 64) == cells).all() and cells.max() == 63
    m = vafile.Measure(grid, centres)
    exact = np.stack([((v - c) ** 2).sum(1) for c in centres], 1)
    at = np.arange(64)
    for c in range(8):
        assert (m.least[c][at, cells].sum(1) <= exact[:, c]).all() and (m.greatest[c][at, cells].sum(1) >= exact[:, c]).all()
    sure = m.sure(cells)
    assert (sure >= 0).mean() > 0.9 and (sure[sure >= 0] == exact.argmin(1)[sure >= 0]).all()
    tie = vafile.Measure(grid, np.stack([centres[0], centres[0]]))
    assert set(tie.sure(cells)) <= {0, -1} and (tie.assign(cells, v) == 0).all()
