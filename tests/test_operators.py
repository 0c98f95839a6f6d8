"""Operators on small frames: edge cases, refusals, readers and writers."""

import hashlib
import json
import struct

import pytest
from pyspark.sql import functions as F

from tessera.functions import arrays, exact, hashing, schema, stats, text
from tessera.operators import aggregates, campaign, filters, graphs, joins, validation, windows
from tessera.sources import readers, writers
from tessera.streaming import windows as streams


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols or df.columns) for r in df.collect())


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()[0]


def test_percentile_index(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "v int").withColumn("g", F.lit("a"))
    assert stats.at_share(df, ["g"], "v", {"p50": 0.5, "p90": 0.9}).first().asDict() == {"g": "a", "n": 4, "total": 10, "least": 1, "p50": 3, "p90": 4, "most": 4}


def test_kappa(spark):
    pairs = spark.createDataFrame([(0, 0), (1, 1), (2, 3), (4, 4)], "a int, b int")
    assert stats.weighted_kappa(pairs, "a", "b").first()["kappa"] == pytest.approx(1 - 0.0625 / ((0 + 1 + 9 + 16 + 1 + 0 + 4 + 9 + 4 + 1 + 1 + 4 + 16 + 9 + 1 + 0) / 16 / 4), abs=1e-4)
    for bad in ((5, 0), (-1, 0)):
        with pytest.raises(ValueError, match="ratings"):
            stats.weighted_kappa(spark.createDataFrame([bad], "a int, b int"), "a", "b")
    same = spark.createDataFrame([(2, 2), (2, 2)], "a int, b int")
    assert stats.weighted_kappa(same, "a", "b").first()["kappa"] is None
    assert stats.weighted_kappa(pairs.where("a > 9"), "a", "b").count() in (0, 1)


def test_wilson_bounds(spark):
    low, high = stats.wilson(F.lit(0), F.lit(0))
    assert one(spark, low) is None
    low, high = stats.wilson(F.lit(10), F.lit(10))
    assert one(spark, low) == pytest.approx(0.787, abs=1e-3) and one(spark, high) == pytest.approx(1.0)


def test_text_functions(spark):
    assert set(one(spark, text.identifier_tokens(F.lit("parseHTTPResponse_v2")))) == {"parse", "http", "response", "parsehttpresponse_v2"}
    assert one(spark, text.first_sentence(F.lit("One here. Two."))) == "One here."
    assert one(spark, text.is_prose(F.lit("This is a plain sentence."))) and not one(spark, text.is_prose(F.lit("x = {1};; y()")))
    assert [one(spark, text.duration_minutes(F.lit(x))) for x in ("90m", "2h", "5s", "")] == [90, 120, None, None]
    assert one(spark, text.parents(F.lit("a/b/c.py"))) == ["a/b", "a"]
    assert one(spark, text.first_json(text.unfenced(F.lit('```json\nx {"a": 1} y\n```')))) == '{"a": 1}'
    assert one(spark, text.filled(F.lit("$name and $names"), F.create_map(F.lit("name"), F.lit("A"), F.lit("names"), F.lit("B")))) == "A and B"


def test_path_mentions(spark):
    cases = {
        "see src/index.html, package.json and style.css": ["src/index.html", "package.json", "style.css"],
        "main.cpp then lib/util.weird": ["main.cpp", "lib/util.weird"],
        "v1.5 e.g. this isn't x.unknown": [],
        "./src/a.py and ../b/c.rs.": ["src/a.py", "b/c.rs"],
        "a file.pyx or file.python": [],
        "(Makefile.toml) x/y.z/": ["Makefile.toml"],
        "http://host/a.html": [],
        "": [],
    }
    for said, want in cases.items():
        assert one(spark, text.path_mentions(F.lit(said))) == want, said


def test_path_gate(spark):
    files = spark.createDataFrame([("src/app/main.py",), ("web/index.html",), ("README.md",)], "path string")
    said = [(1, "fix src/app/main.py"), (2, "fix app/main.py and index.html"), (3, "fix ain.py"), (4, "add src/app/new.py"), (5, "add other/new.py"), (6, "add new.py"), (7, "nothing"), (8, "add src/new.rst"), (9, "index.htm")]
    prompts = spark.createDataFrame(said, "id int, text string")
    assert [r["id"] for r in filters.path_gate(prompts, files, "id", "text").where("all_known").orderBy("id").collect()] == [1, 2, 7]
    assert [r["id"] for r in filters.path_gate(prompts, files, "id", "text", new_files=True).where("all_known").orderBy("id").collect()] == [1, 2, 3, 4, 6, 7, 8, 9]
    refs = filters.reference_appended(prompts, files, "id", "text", F.lit("drawn"), "s", 1.0)
    assert rows(refs, "id", "reference")[:3] == [(1, "src/app/main.py"), (2, "web/index.html"), (3, "drawn")]
    assert {r["reference"] for r in filters.reference_appended(prompts, files, "id", "text", F.lit("drawn"), "s", -1.0).collect()} == {None}


def test_doc_pairs(spark):
    units = [
        ("r", "src/walker.py", 1, "walkTree", "returns the list of every open file it knows. More."),
        ("r", "src/walker.py", 2, "walkTree", "walkTree  visits every folder below the given place. More."),
        ("r", "src/walker.py", 3, "walkTree", "Visits every tree below the given place."),
        ("r", "src/walker.py", 4, "go", "The walker goes below the given place."),
        ("r", "src/a.py", 5, "r", "Runs (fast) over all the known places here"),
        ("r", "src/a.py", 6, "zz", "Too short a line"),
        ("r", "src/a.py", 7, "zz", "  \n "),
        ("r", "src/a.py", 8, "zz", None),
        ("r", "src/a.py", 9, "r", "reads 12 34 56 78 numbers"),
    ]
    out = filters.doc_pairs(spark.createDataFrame(units, "repo string, file string, line int, symbol string, doc string"))
    assert rows(out, "line", "task", "query") == [
        (1, "returns the list of every open file it knows.", "returns list every"),
        (2, "visits every folder below the given place.", "visits every folder"),
    ]
    assert one(spark, text.is_prose(F.lit("Well-known words, aren't they?"))) and not any(one(spark, text.is_prose(F.lit(f"plain words here {c} and some more there"))) for c in "(){};=<>[]")
    assert one(spark, text.is_prose(F.lit("words | words \\ words words words words words words words words")))


def test_effects(spark):
    roots = F.array(F.lit("src"), F.lit("docs/api/"))
    good = ["src/a", "src", "/work/p/src/x", "./src//y", "docs/api", "/work/p/./docs/api/z"]
    bad = ["srcs/a", "src/../etc", "/work/pp/src/a", "/etc/passwd", "docs", "docs/apis", "/work/p", "/work", "..", ""]
    for path in good + bad:
        assert one(spark, text.authorized(F.lit(path), F.lit("/work/p"), roots)) == (path in good), path
    effects = spark.createDataFrame([("t", "s1", "src/a"), ("t", "s9", "/etc/x"), ("t", "s9", "src/b")], "task string, session string, path string").withColumns({"project": F.lit("/work/p"), "roots": roots})
    made = spark.createDataFrame([("t", 3, 2), ("u", 1, 1)], "task string, made int, expected int")
    out = filters.effect_receipt(effects, spark.createDataFrame([("t", "s1")], "task string, session string"), made, "task")
    assert rows(out, "task", "unauthorized", "interventions") == [("t", 1, 3), ("u", 0, 0)]


def test_nested_partition(spark):
    df = spark.createDataFrame([(1, ("train",)), (2, ("test",)), (3, (None,)), (4, None)], "id int, meta struct<split: string>")
    assert rows(filters.of_partition(df, "train"), "id") == [(1,)]


def test_arrays(spark):
    assert one(spark, arrays.common_prefix(F.array(*map(F.lit, (1, 2, 3))), F.array(*map(F.lit, (1, 2, 4, 5))))) == 2
    assert one(spark, arrays.common_prefix(F.array(*map(F.lit, (1, 2))), F.array(*map(F.lit, (1, 2, 3))))) == 2
    assert one(spark, arrays.later_wins(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3)))) == {"a": 1, "b": 3}


def test_canonical(spark):
    assert hashing.canonical({"b": 1.0, "a": [None, "é"]}) == '{"a":[null,"é"],"b":1.0}'
    with pytest.raises(ValueError):
        hashing.canonical({"x": float("nan")})
    assert one(spark, hashing.canonical_digest(F.lit('{"b": 2, "a": 1}'))) == one(spark, F.sha2(F.lit('{"a":1,"b":2}'), 256))
    assert one(spark, hashing.canonical_digest(F.lit("no json"))) is None


def test_asof_ties_and_misses(spark):
    left = spark.createDataFrame([("s", 1, "a"), ("s", 5, "b"), ("t", 5, "c")], "k string, at int, name string")
    right = spark.createDataFrame([("s", 5, 50), ("s", 3, 30), ("s", 9, 90)], "k string, t int, v int")
    assert rows(joins.asof(left, right, ["k"], "at", "t", ["v"]), "name", "v") == [("a", None), ("b", 50), ("c", None)]
    assert rows(joins.asof(left, right, ["k"], "at", "t", ["v"], inclusive=False), "name", "v") == [("a", None), ("b", 30), ("c", None)]


def test_checked_join_refuses(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(joins.IntegrityError):
        joins.checked_join(a, b, "k")
    assert rows(joins.checked_join(a.where("k = 1"), b, "k")) == [(1, "x")]


def test_differences_with_nulls(spark):
    a = spark.createDataFrame([(None, 1), (1, 2), (2, None)], "k int, v int")
    b = spark.createDataFrame([(None, 1), (2, 5), (3, 0)], "k int, v int")
    assert rows(joins.differences(a, b, ["k"], ["v"]), "k", "difference") == [(1, "removed"), (2, "changed"), (3, "added")]


def test_components_and_ids(spark):
    nodes = spark.createDataFrame([(c,) for c in "abcdefg"], "node string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("e", "d"), ("f", "f")], "a string, b string")
    found = graphs.connected_components(nodes, edges)
    assert rows(found, "node", "component") == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "d"), ("f", "f"), ("g", "g")]
    assert graphs.component_ids(found).count() == 4
    assert rows(graphs.connected_components(nodes, edges.where("a = 'zz'")), "node", "component") == [(c, c) for c in "abcdefg"]


def brute_allocation(comps, seed, fractions, minimums):
    """cid -> partition by the rule: held, then what held ones leave of each stratum's minimums in hash order, then fractions."""
    place = lambda c: int(hashlib.sha256(f"{seed}:{c}".encode()).hexdigest()[:12], 16) / 2**48
    out, strata = {}, {}
    for cid, stratum, held in comps:
        if held:
            out[cid] = held
        else:
            strata.setdefault(stratum, []).append(cid)
    for stratum, free in strata.items():
        free.sort(key=lambda c: (place(c), c))
        for p in graphs.MINIMUM_ORDER:
            have = sum(1 for _, s, h in comps if s == stratum and h == p)
            for _ in range(max(0, minimums.get(p, 0) - have)):
                out[free.pop(0)] = p
        for c in free:
            edge = 0.0
            for p in graphs.FRACTION_ORDER:
                edge += fractions.get(p, 0.0)
                if place(c) < edge:
                    out[c] = p
                    break
    return out


def test_allocation(spark):
    given = [(f"c{i}", (None, "s", "t")[i % 3], {1: "system_test", 2: "train", 4: "development"}.get(i % 17)) for i in range(120)]
    comps = spark.createDataFrame(given, "cid string, stratum string, holdout string")
    fractions = {"train": 0.5, "validation": 0.25, "system_test": 0.25}
    for minimums in ({}, {"development": 4}, {"system_test": 4, "development": 3, "validation": 2, "train": 5}):
        out = graphs.allocate(comps, "x", fractions, minimums)
        assert {r["cid"]: r["partition"] for r in out.collect()} == brute_allocation(given, "x", fractions, minimums) and out.count() == 120
    few = spark.createDataFrame([("a", "s", None), ("b", "s", "train"), ("c", "t", None), ("d", "t", None)], comps.schema)
    with pytest.raises(graphs.AllocationError) as refused:
        graphs.allocate(few, "x", {"train": 1.0}, {"train": 2, "validation": 3})
    assert refused.value.args[1] == {"s": 3, "t": 3}
    for bad in ({"train": 0.5}, {"train": 1.5, "validation": -0.5}, {"other": 1.0}):
        with pytest.raises(ValueError, match="fractions"):
            graphs.allocate(comps, "x", bad)
    for bad in ({"other": 1}, {"train": -1}, {"train": 1.5}):
        with pytest.raises(ValueError, match="minimums"):
            graphs.allocate(comps, "x", fractions, bad)


def test_ids_of_large_components(spark):
    members = spark.createDataFrame([(f"n{i}", "a" if i < 500 else "b") for i in range(520)], "node string, component string")
    want = hashlib.sha256("\n".join(sorted(f"n{i}" for i in range(500, 520))).encode()).hexdigest()[:16]
    whole, sliced = (dict(rows(graphs.component_ids(members.repartition(5), most=n))) for n in (1000, 100))
    assert whole["b"] == want == sliced["b"] and whole["a"] != sliced["a"]
    slices = {}
    for n in (f"n{i}" for i in range(500)):
        slices.setdefault(hashlib.sha256(n.encode()).hexdigest()[:3], []).append(n)
    lines = sorted(f"{k}:{hashlib.sha256(chr(10).join(sorted(v)).encode()).hexdigest()}" for k, v in slices.items())
    assert sliced["a"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]
    nodes = spark.createDataFrame([("x", "s", None), ("x", "t", "h"), ("y", "s", "h"), ("y", None, "h")], "node string, stratum string, holdout string")
    assert rows(graphs.declaration_conflicts(nodes, ["stratum", "holdout"])) == [("x", "stratum")]


def test_tree_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "parent int, child int")
    with pytest.raises(ValueError):
        graphs.reachable(edges, spark.createDataFrame([(1,)], "root int"))


def test_outcomes_and_states(spark):
    t = spark.createDataFrame([(1, "success"), (1, "unknown"), (2, None), (3, "failure"), (3, "unknown")], "k int, o string")
    assert rows(aggregates.turn_outcome(t, ["k"], "o")) == [(1, "unknown"), (2, "success"), (3, "failure")]
    d = spark.createDataFrame([(1, "human"), (1, "human"), (2, "skip"), (3, "automatic"), (4, "other")], "i int, kind string")
    assert rows(filters.item_states(d, "i")) == [(1, "labelled"), (2, "skipped"), (3, "automatic"), (4, "open")]


def test_usage_prefers_present_key(spark):
    docs = spark.createDataFrame([('{"prompt_tokens": 0, "input_tokens": 9}',), ('{"input_tokens": 9}',), ("{}",)], "d string")
    assert [r[0] for r in docs.select(aggregates.usage_tokens(F.col("d"))).collect()] == [0, 9, 0]


def test_admission(spark):
    t = spark.createDataFrame([("s", 1, True, "bad"), ("s", 2, False, None), ("s", 3, False, None)], "k string, n int, failed boolean, x string")
    out = validation.admitted(t, ["k"], ["n"], F.col("x"), F.col("failed"))
    assert rows(out, "n", "category", "first_admitted") == [(1, "excluded:bad", False), (2, "recovery", True), (3, "recovery", False)]


def test_admission_breaks_ties(spark):
    # two operations of one time and order, two reasons at one position: the order of the rows must not matter
    ops = [("e", 1, 1, "r1", "passed"), ("e", 1, 1, "r2", "failed"), ("f", 1, 1, "r2", "passed"), ("f", 1, 1, "r1", "failed")]
    calls = [(2, 1, True, True, "open", "known", "r1"), (2, 1, True, True, "settled", "unknown", "r1"), (3, 1, True, True, "settled", "known", "r1")]
    turns = spark.createDataFrame([(e, e, n, n, True, None, None) for e, n in (("e", 1), ("e", 2), ("e", 3), ("f", 4))], "episode string, session string, turn long, settled_at long, committed boolean, host_exclusion string, closeout_reason string")
    seen = spark.createDataFrame([("e",)], "episode string")
    for turned in (False, True):
        o = spark.createDataFrame(ops[::-1] if turned else ops, "episode string, started_at long, order long, source_revision string, source_verdict string").coalesce(1)
        c = spark.createDataFrame(calls[::-1] if turned else calls, "turn long, position long, offered boolean, recorded boolean, settlement string, effect_state string, source_revision string").coalesce(1)
        c = c.withColumns({"replays_unknown_effects": F.lit(False), "invoked": F.lit(True), "source_verdict": F.lit("failed"), "semantic_outcome": F.when(F.col("turn") == 3, "failure").otherwise("success")})
        # e starts with r1 and ends with r2, which never passed; f ends with r2, which did
        assert rows(campaign.admission(turns, c, o, seen), "turn", "category", "reason") == [(1, None, "stale_verification"), (2, None, "unknown_effects"), (3, "diagnostic", None), (4, "closeout", None)]


def test_early_stop(spark):
    df = spark.createDataFrame([("a", i, i % 2 == 0) for i in range(8)], "k string, n int, ok boolean")
    assert [r[1] for r in rows(windows.accepted_up_to(df, ["k"], ["n"], F.col("ok"), 2), "k", "n")] == [0, 1, 2]


def test_bootstrap_is_repeatable(spark):
    v = spark.createDataFrame([(i, float(i % 3)) for i in range(12)], "k int, v double")
    a, b = (aggregates.bootstrap_interval(v, "k", "v", 400, 0.95, 7).first() for _ in range(2))
    assert a == b and a["low"] < a["mean"] < a["high"]


def test_readers_and_writers(spark, tmp_path):
    rows_ = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, task string")
    assign = spark.createDataFrame([("a", "train"), ("b", "validation")], "task string, partition string")
    out = f"file://{tmp_path}/splits"
    assert writers.write_splits(rows_, assign, "task", out) == {"train": 2, "validation": 1}
    with pytest.raises(joins.IntegrityError):
        writers.write_splits(rows_, assign.where("task = 'a'"), "task", out)
    assert spark.read.json(out).count() == 3  # what was there stays
    assert writers.write_splits(rows_.where("id = 1"), assign, "task", out) == {"train": 1}
    (tmp_path / "x.jsonl").write_text('{"id": 1}\n\n{"id": "no"}\n')
    assert rows(readers.jsonl(spark, f"file://{tmp_path}/x.jsonl", "id int", tolerant=True)) == [(1,)]
    with pytest.raises(Exception):  # noqa: B017
        readers.jsonl(spark, f"file://{tmp_path}/x.jsonl", "id int").collect()
    once = f"file://{tmp_path}/once"
    assert writers.write_once(spark, {"a": 1}, once) and not writers.write_once(spark, {"a": 1}, once)
    with pytest.raises(joins.IntegrityError):
        writers.write_once(spark, {"a": 2}, once)
    ledger = f"file://{tmp_path}/ledger"
    writers.append_ledger(rows_, ledger, ["id"])
    writers.append_ledger(rows_, ledger, ["id"])
    assert spark.read.parquet(ledger).count() == 3
    manifest = writers.release({"rows": rows_}, f"file://{tmp_path}/release")
    assert all(len(r["sha256"]) == 64 for r in manifest.collect())
    assert writers.markdown(rows_.orderBy("id"), "Rows").startswith("## Rows\n\n| id | task |")


def test_bundle_and_headers(spark, tmp_path):
    folder = tmp_path / "bundle"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"id": 1}\n')
    sums = readers.files(spark, f"file://{folder}").select("name", "sha256")
    assert readers.checked_bundle(spark, f"file://{folder}", {"a.jsonl": "id int"}, sums)["a.jsonl"].count() == 1
    with pytest.raises(joins.IntegrityError):
        readers.checked_bundle(spark, f"file://{folder}", {}, sums.withColumn("sha256", F.lit("0")))
    head = json.dumps({"__metadata__": {}, "w": {"dtype": "F32", "shape": [2, 3], "data_offsets": [0, 24]}}).encode()
    (folder / "m.safetensors").write_bytes(struct.pack("<Q", len(head)) + head + bytes(24))
    (folder / "bad.safetensors").write_bytes(b"xx")
    assert rows(readers.tensor_headers(spark, f"file://{folder}")) == [("bad.safetensors", None, None), ("m.safetensors", 1, 6)]
    with pytest.raises(ValueError, match="unknown keys"):
        readers.strict_config('{"a": 1, "z": 2}', {"a": int})


def test_stream_appends_once(spark, tmp_path):
    source, target = tmp_path / "in", f"file://{tmp_path}/out"
    df = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "id int, v string")
    df.write.parquet(f"file://{source}")
    for _ in range(2):  # a second run with a fresh checkpoint replays all rows
        ck = tmp_path / f"ck{_}"
        q = spark.readStream.schema("id int, v string").parquet(f"file://{source}").writeStream.foreachBatch(streams.resumed(["id"], target)).option("checkpointLocation", f"file://{ck}").trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert rows(spark.read.parquet(target)) == [(1, "x"), (2, "y")]


def test_stream_windows_match_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(f"file://{tmp_path}/ev")
    stream = spark.readStream.schema(events.schema).parquet(f"file://{tmp_path}/ev")
    q = streams.tumbling(stream, "ts", "1 day", ["event_type"]).writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"file://{tmp_path}/ckw").start()
    q.awaitTermination(120)
    batch = streams.tumbling(events, "ts", "1 day", ["event_type"])
    pick = lambda df: sorted((str(r["start"]), r["event_type"], r["n"]) for r in df.collect())
    assert pick(spark.table("days")) == pick(batch)


def test_split_write_keeps_the_target(spark, tmp_path, monkeypatch):
    made = spark.createDataFrame([(1, "a"), (2, "b")], "id int, task string")
    assign = spark.createDataFrame([("a", "train"), ("b", "validation")], "task string, partition string")
    out = f"file://{tmp_path}/splits"
    writers.write_splits(made, assign, "task", out)
    rename = writers._rename

    def failing(s, source, target):
        if ".stage-" in source:
            raise OSError("no")
        rename(s, source, target)

    monkeypatch.setattr(writers, "_rename", failing)
    with pytest.raises(OSError, match="no"):
        writers.write_splits(made.where("id = 1"), assign, "task", out)
    monkeypatch.undo()
    assert spark.read.json(out).count() == 2 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["splits"]
    # a writer that died between the renames: the next one brings the target back before it replaces it
    (tmp_path / "splits").rename(tmp_path / "splits.old-1")
    with pytest.raises(OSError):
        monkeypatch.setattr(writers, "_rename", failing)
        writers.write_splits(made.where("id = 1"), assign, "task", out)
    monkeypatch.undo()
    assert spark.read.json(out).count() == 2
    assert writers.write_splits(made.where("id = 1"), assign, "task", out) == {"train": 1} and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["splits"]


def test_writers_take_turns(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    once = f"file://{tmp_path}/once"

    def write(i):
        try:
            return writers.write_once(spark, {"writer": i}, once)
        except joins.IntegrityError:
            return None

    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(write, range(4)))
        assert got.count(True) == 1 and got.count(None) == 3
        ledger = f"file://{tmp_path}/ledger"
        frames = [spark.range(i, i + 6).withColumn("by", F.lit(i)) for i in range(4)]
        added = list(pool.map(lambda df: writers.append_ledger(df, ledger, ["id"]).count(), frames))
    assert sum(added) == 9 == spark.read.parquet(ledger).count() == spark.read.parquet(ledger).select("id").distinct().count()
    assert writers.append_ledger(frames[0], ledger, ["id"]).count() == 0
    with writers.locked(spark, ledger), pytest.raises(TimeoutError), writers.locked(spark, ledger, seconds=0.1):
        pass


def test_release_is_sealed(spark, tmp_path):
    folder = f"file://{tmp_path}/release"
    made = spark.createDataFrame([(1, "a"), (2, "b")], "id int, task string")
    manifest = writers.release({"train": made, "test": made.limit(1)}, folder, card="# Card", provenance={"b": 1, "a": [2]})
    assert {r["part"] for r in manifest.collect()} == {"train", "test"}
    names = writers.verify(spark, folder)
    assert {"README.md", "PROVENANCE.json", "train.schema.json", "test.schema.json"} <= set(names) and any(n.startswith("train/part-") for n in names)
    (tmp_path / "release" / "README.md").write_text("# Other")
    (tmp_path / "release" / ".README.md.crc").unlink(missing_ok=True)
    with pytest.raises(joins.IntegrityError, match="README.md"):
        writers.verify(spark, folder)
    with pytest.raises(joins.IntegrityError, match="has no"):
        writers.verify(spark, f"{folder}/train")
    report = writers.digested({"rows": 3})
    assert writers.still_digested(report) and not writers.still_digested(report | {"rows": 4})


def test_other_readers(spark, tmp_path):
    for shard, n in (("s1", 2), ("s2", 1)):
        (tmp_path / "shards" / shard).mkdir(parents=True)
        (tmp_path / "shards" / shard / "rows.jsonl").write_text("".join(f'{{"id": {i}}}\n' for i in range(n)))
    root = f"file://{tmp_path}/shards"
    ordered = readers.ordered_jsonl(spark, f"{root}/*", "id int").collect()
    assert [r["file"].split("/")[-2] for r in ordered] == ["s1", "s1", "s2"]
    assert rows(readers.files(spark, root), "name") == [("s1/rows.jsonl",), ("s2/rows.jsonl",)]
    manifest = spark.createDataFrame([("s1", "settled"), ("s2", "failed")], "shard string, status string")
    assert rows(readers.sharded(spark, f"{root}/*", "id int", manifest), "id", "status") == [(0, "failed"), (0, "settled"), (1, "settled")]
    assert readers.has_rows(manifest) and not readers.has_rows(manifest.limit(0))
    digests = {r["name"]: r["sha256"] for r in readers.files(spark, root).collect()}
    found = readers.blobs(spark, f"{root}/s1", spark.createDataFrame([(digests["s1/rows.jsonl"],), ("0",)], "sha256 string"))
    assert {(r["sha256"] == "0", r["content"] is None) for r in found.collect()} == {(True, True), (False, False)}
    documents = spark.createDataFrame([('{"schema": "a/1"}',), ('{"schema": "b/1"}',), ("{}",)], "value string")
    assert [r["kind"] for r in readers.by_schema(documents, {"a/1": "task", "b/1": "row"}).collect()] == ["task", "row", "unknown"]
    import sqlite3

    with sqlite3.connect(tmp_path / "store.db") as db:
        db.execute("create table turns(status text)")
        db.executemany("insert into turns values (?)", [("done",), ("open",)])
    assert rows(readers.snapshot(spark, str(tmp_path / "store.db"), "select status, count(*) from turns group by 1", "status string, n long")) == [("done", 1), ("open", 1)]
    (tmp_path / "t.csv").write_text("id,name\n1,a\nx,b\n")
    assert rows(readers.csv(spark, f"file://{tmp_path}/t.csv", "id int, name string", tolerant=True)) == [(1, "a")]
    manifest.write.orc(f"file://{tmp_path}/orc")
    assert readers.orc(spark, f"file://{tmp_path}/orc").count() == 2
    spec = {"a": int, "b": ({"c": str}, {"d": int})}
    assert readers.strict_config('{"a": 1, "b": {"c": "x"}}', spec) == {"a": 1, "b": {"c": "x"}}
    for bad, said in (('{"a": 1, "b": {"c": 1}}', "wrong types: b.c"), ('{"a": 1, "b": {}}', "missing keys: b.c"), ('{"a": 1, "b": {"c": "x", "z": 1}}', "unknown keys: b.z"), ('{"a": true, "b": {"c": "x"}}', "wrong types: a"), ("[]", "the document")):
        with pytest.raises(ValueError, match=said):
            readers.strict_config(bad, spec)


def test_schema_compiles(spark):
    rule = {
        "$schema": "x", "type": "object", "required": ["id", "tags"], "additionalProperties": False,
        "properties": {
            "id": {"type": "integer", "minimum": 1, "exclusiveMaximum": 10},
            "name": {"type": ["string", "null"], "minLength": 2, "maxLength": 4, "pattern": "^[a-z]+$"},
            "tags": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "items": {"type": "object", "required": ["k"], "properties": {"k": {"enum": ["a", 2, None, True]}}}},
            "rate": {"type": "number", "maximum": 1, "exclusiveMinimum": 0},
            "fixed": {"const": "v1"}, "never": False,
        },
    }
    ok = '"id": 3, "tags": [{"k": "a"}]'
    cases = [
        (f"{{{ok}}}", None), (f'{{{ok}, "name": null, "rate": 0.5, "fixed": "v1"}}', None), ('{"id": 3.0, "tags": [{"k": 2}, {"k": null}, {"k": true}]}', None),
        ("[]", "$: type"), ('"x"', "$: type"), ("null", "$: type"), ('{"id": 3}', "$: required tags"), ('{"tags": []}', "$: required id"),
        (f'{{{ok}, "more": 1}}', "$: additionalProperties"), ('{"id": "3", "tags": [{"k": 2}]}', "$.id: type"), ('{"id": 0, "tags": [{"k": 2}]}', "$.id: minimum"),
        ('{"id": 10, "tags": [{"k": 2}]}', "$.id: exclusiveMaximum"), ('{"id": 1.5, "tags": [{"k": 2}]}', "$.id: type"), (f'{{{ok}, "name": "a"}}', "$.name: minLength"), (f'{{{ok}, "name": "abcde"}}', "$.name: maxLength"),
        (f'{{{ok}, "name": "aB"}}', "$.name: pattern"), (f'{{{ok}, "name": 5}}', "$.name: type"), ('{"id": 3, "tags": []}', "$.tags: minItems"), ('{"id": 3, "tags": [{"k": 2}, {"k": "a"}, {"k": null}, {"k": true}]}', "$.tags: maxItems"),
        ('{"id": 3, "tags": [{"k": 2}, {"k": 2}]}', "$.tags: uniqueItems"), ('{"id": 3, "tags": [{"k": 2}, {}]}', "$.tags[]: required k"), ('{"id": 3, "tags": [{"k": "b"}]}', "$.tags[].k: enum"), ('{"id": 3, "tags": [7]}', "$.tags[]: type"),
        (f'{{{ok}, "rate": 2}}', "$.rate: maximum"), (f'{{{ok}, "rate": 0}}', "$.rate: exclusiveMinimum"), (f'{{{ok}, "fixed": "v2"}}', "$.fixed: const"), (f'{{{ok}, "never": 1}}', "$.never: false"),
    ]
    df = spark.createDataFrame(cases, "doc string, want string").withColumn("got", schema.first_error(F.try_parse_json("doc"), rule))
    assert [(r["doc"], r["got"]) for r in df.collect()] == cases
    # what isn't JSON, or isn't there, has no type
    bad = spark.createDataFrame([("{",), (None,)], "doc string").select(schema.first_error(F.try_parse_json("doc"), rule).alias("e"))
    assert [r["e"] for r in bad.collect()] == ["$: type"] * 2
    with pytest.raises(ValueError, match="oneOf"):
        schema.first_error(F.lit(None), {"properties": {"a": {"oneOf": []}}})


def test_exact_functions(spark):
    values = [0.5, 1.5, 2.675, 1.005, 0.125, -0.125, 1e300, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(exact.half_even(F.col("v"), 2).alias("r"))
    got = [r["r"] for r in df.collect()]
    assert [x for x in got if x == x and x is not None] == [round(v, 2) for v in values if v is not None and v == v] and got[-1] is None
    assert one(spark, exact.set_json(F.lit('{"b": {"x": 1}, "a": 2}'), "b.y.z", F.lit("[3]"))) == '{"a":2,"b":{"x":1,"y":{"z":[3]}}}'
    assert one(spark, exact.set_json(F.lit("[1]"), "a", F.lit("1"))) is None and one(spark, exact.set_json(F.lit('{"a": 1}'), "a.b", F.lit("1"))) is None
    names = exact.register(spark)
    assert set(names) >= {"half_even", "closed_draw", "seeded_position"}
    r = spark.sql("select seeded_position('s', 'k') p, closed_draw('s', 'k') d, first_sentence('One. Two.') f, duration_minutes('2h') m, file_stem('a/b.c.d') s, half_even(2.675D, 2) h").first()
    assert (r["f"], r["m"], r["s"], r["h"]) == ("One.", 120, "b", round(2.675, 2))
    assert r["p"] == one(spark, hashing.position("s", F.lit("k"))) and r["d"] == one(spark, hashing.closed_draw("s", F.lit("k")))


def test_signatures_and_bindings(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id int, name string")
    held = campaign.run_signature(df, {"units": ["x"]})
    assert campaign.run_signature(df.repartition(3).orderBy(F.desc("id")), {"units": ["x"]}) == held
    assert campaign.run_signature(df.dropDuplicates(), {"units": ["x"]}) != held and campaign.run_signature(df.limit(0), {})["inputs_sha256"]
    assert campaign.check_signature(None, held) == held == campaign.check_signature(held, held)
    with pytest.raises(joins.IntegrityError, match="units"):
        campaign.check_signature(held, held | {"units": []})
    depends = {"rows": ("host", "catalog"), "heads": ("host",)}
    values = {"host": "h1", "catalog": "c1"}
    binding = campaign.bound(values, "rows", depends)
    assert binding["sha256"] == hashlib.sha256(b'{"catalog":"c1","host":"h1"}').hexdigest()
    assert campaign.still_bound(binding, values | {"other": "x"}, "rows", depends) and not campaign.still_bound(binding, values | {"host": "h2"}, "rows", depends)
    for bad in (({"host": ""}, "rows"), ({"host": "h"}, "rows"), (values, "none")):
        with pytest.raises(ValueError):
            campaign.bound(*bad, depends)


def test_scaled_and_routes(spark):
    a = spark.createDataFrame([("a", 10, 0.5, 3), ("b", 1, 0.5, 3), ("c", 5, 0.5, 3)], "id string, per_workspace int, follow_up_rate double, max_follow_ups int")
    assert rows(campaign.scaled(a, share=0.5), "id", "per_workspace") == [("a", 5), ("b", 1), ("c", 2)]
    assert rows(campaign.scaled(a, cap=4, chosen=["a"]), "id", "per_workspace") == [("a", 4)]
    with pytest.raises(ValueError, match="unknown archetypes: z"):
        campaign.scaled(a, chosen=["a", "z"])
    with pytest.raises(ValueError):
        campaign.scaled(a, share=1.5)
    windows.check_routes([("m", 1), ("n", 0)], {"m", "n"})
    for bad in ([], [("m", 0)], [("m", -1), ("n", 2)], [("x", 1)], [("m", 1), ("m", 2)]):
        with pytest.raises(ValueError):
            windows.check_routes(bad, {"m", "n"})


def test_quota_and_ledger_edges(spark):
    schema_ = "partition string, place int, task string, focus string, grp string, attempt int, success boolean"
    a = spark.createDataFrame([("p", 1, "t1", "f", "g1", 0, False), ("p", 1, "t1", "f", "g1", 1, True), ("p", 1, "t1", "f", "g1", 2, True), ("p", 2, "t2", "f", "g1", 0, True), ("p", 3, "t3", "f", "g2", 0, False), ("p", 4, "t4", "f", "g2", 0, True), ("p", 5, "t5", "f", "g3", 0, True), ("q", 1, "u", "f", "g", 0, False)], schema_)
    got = rows(campaign.quota_collection(a, 2, 2, ["f"]), "task", "attempt", "admitted")
    assert got == [("t1", 0, False), ("t1", 1, True), ("t2", 0, True), ("t3", 0, False), ("t4", 0, True), ("u", 0, False)]
    assert campaign.quota_collection(a, 9, 2, ["f"]).count() == 7 and campaign.quota_collection(a.limit(0), 2, 2, ["f"]).count() == 0


def test_interval_join_edges(spark):
    points = spark.createDataFrame([(k, float(v)) for k in ("a", "b") for v in range(-12, 13)], "k string, at double")
    spans = spark.createDataFrame([("a", 1, -5.0, 0.0), ("a", 2, 0.0, 0.5), ("a", 3, 3.0, 3.0), ("a", 4, -100.0, 100.0), ("c", 5, 0.0, 9.0), ("a", 6, 2.5, 7.5)], "k string, span int, low double, high double")
    got = rows(joins.interval_join(points, spans, ["k"], "at", "low", "high", 2.0), "span", "at")
    want = sorted((s, a) for k, a in ((r["k"], r["at"]) for r in points.collect()) for j, s, low, high in ((r["k"], r["span"], r["low"], r["high"]) for r in spans.collect()) if j == k and low <= a < high)
    assert got == want


def _streamed(spark, tmp_path, name, make, batches):
    """Rows that a stream over JSON files, one batch each, appends to memory."""
    source = tmp_path / name
    source.mkdir()
    stream = spark.readStream.schema("k string, ts timestamp, bad boolean, value double").option("maxFilesPerTrigger", 1).json(f"file://{source}")
    query = make(stream).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"file://{tmp_path}/{name}-ck").start()
    try:
        for i, batch in enumerate(batches):
            (source / f"{i}.json").write_text("".join(json.dumps(dict(zip(("k", "ts", "bad", "value"), r, strict=True))) + "\n" for r in batch))
            query.processAllAvailable()
        return spark.table(name).collect()
    finally:
        query.stop()


def test_late_rows_are_dropped(spark, tmp_path):
    at = lambda h, m=0: f"2024-01-01T{h:02}:{m:02}:00Z"
    batches = [[("a", at(0, 5), False, 1.0), ("a", at(0, 50), False, 1.0)], [("a", at(5), False, 1.0)], [("a", at(0, 10), False, 1.0), ("a", at(4, 30), False, 1.0)], [("a", at(9), False, 1.0)], [("a", at(9, 1), False, 1.0)]]
    got = _streamed(spark, tmp_path, "late", lambda s: streams.tumbling(s, "ts", "1 hour", ["k"], "1 hour"), batches)
    # the row of hour 0 that came after the watermark had passed it counts nowhere; that of hour 4 was in time
    assert sorted((r["start"].hour, r["n"]) for r in got) == [(0, 2), (4, 1), (5, 1)]


def test_stream_stops(spark, tmp_path):
    at = lambda m: f"2024-01-01T00:{m:02}:00Z"
    batches = [[("a", at(0), True, 0.0), ("b", at(0), False, 0.0), ("a", at(1), True, 0.0)], [("a", at(2), True, 0.0), ("a", at(3), True, 0.0)], [("c", at(30), False, 0.0)], [("c", at(31), True, 0.0), ("b", at(32), False, 0.0)], [("c", at(59), True, 0.0)], [("d", at(59), True, 0.0)]]
    got = sorted((r["k"], r["reason"], r["at"].minute) for r in _streamed(spark, tmp_path, "stops", lambda s: streams.stopped(s, "k", "ts", "bad", 2, "20 minutes"), batches))
    assert got == [("a", "faults", 2), ("b", "overdue", 20), ("c", "overdue", 50)]
