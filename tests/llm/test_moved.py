"""What is moved on the way to near-duplicates: few rows beside those that can be linked."""

from pyspark.sql import functions as F

from cardproof.llm import components, line_dedup, spotsigs


def test_rows_of_a_few_ids_are_found_with_few_others(spark):
    rows = spark.range(20_000).selectExpr("if(id = 7, null, id) as doc_id")
    ids = spark.createDataFrame([(3,), (None,), (19_999,), (3,)], "first long")
    found = [r["doc_id"] for r in components.likely_in(rows, "doc_id", ids).collect()]
    assert {3, None, 19_999} <= set(found) and len(found) < 10
    assert components.likely_in(rows, "doc_id", ids.filter("first < 0")).count() == 0


def test_few_pairs_need_their_own_rows_only(spark):
    rows = spark.range(100).selectExpr("id as rep", "array(id) as shingles")
    pairs = lambda n: spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    assert sorted(r["rep"] for r in components.named_by(pairs(2), rows).collect()) == [0, 1, 2]
    assert components.named_by(pairs(50), rows).count() == 100


def test_texts_are_moved_to_the_next_without_what_is_derived(spark):
    rows = spark.createDataFrame([(i, f"the w{i} v{i}") for i in range(20)], "doc_id long, text string")
    moved = spotsigs.with_next(rows, ["text"], lambda some: some.withColumn("length", F.length("text")))
    plan = moved._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("RepartitionByExpression [bucket", 1)[1].split("Relation", 1)[0].split("LogicalRDD", 1)[0]
    assert "length(" in plan and "length(" not in below
    found = moved.orderBy("doc_id").collect()
    assert [r["next_text"] for r in found] == [f"the w{(i + 1) % 20} v{(i + 1) % 20}" for i in range(20)]


def test_rows_are_moved_to_their_bucket_once(spark):
    rows = spark.createDataFrame([(i, f"the w{i} v{i}") for i in range(20)], "doc_id long, text string")
    plan = spotsigs.with_next(rows, ["text"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def stored_by(module, monkeypatch):
    """The frames that a module stores from now on."""
    stored, store = [], module.durable
    monkeypatch.setattr(module, "durable", lambda df: stored.append(store(df)) or stored[-1])
    return stored


def test_elements_that_lead_to_no_pair_are_not_stored(spark, monkeypatch):
    stored = stored_by(components, monkeypatch)
    rows = [(i, i, [1000 * i + k for k in range(50)]) for i in range(20)] + [(20, 20, list(range(50)))]
    found = components.prefix_pairs(spark.createDataFrame(rows, "rep long, of long, shingles array<long>"), 80).collect()
    assert [tuple(r) for r in found] == [(0, 20)]
    assert sum(df.count() for df in stored) < 100  # of 1,050 elements


def test_lines_of_few_pairs_are_compared_without_stored_sets(spark, monkeypatch):
    lines = [f"the line number one of {i // 2} has words enough to be like its twin {'x' * (i % 2)}" for i in range(8)] + ["nothing like it in this table"]
    texts = spark.createDataFrame(list(enumerate(lines)), "line_key long, line string")
    narrow = texts.select(F.col("line_key").alias("rep"), line_dedup.shingle_hashes(F.col("line")).alias("s"))
    narrow = narrow.select("rep", F.size("s").alias("n"), line_dedup.range_minima("s").alias("minima"))
    confirmed = lambda pairs: {
        tuple(r) for r in line_dedup._confirmed(spark.createDataFrame(pairs, "a long, b long"), texts, narrow, 12, 80).collect()
    }
    stored = stored_by(line_dedup, monkeypatch)
    twins = [(i, i + 1) for i in range(0, 8, 2)]
    assert confirmed([*twins, (0, 8)]) == set(twins)
    assert not any(kind.startswith("array") for df in stored for _, kind in df.dtypes)
    every = [(i, j) for i in range(8) for j in range(i + 1, 9)]
    assert confirmed(every) & set(twins) == set(twins) and confirmed(every) == confirmed_one_by_one(lines, every)
    assert any(kind.startswith("array") for df in stored for _, kind in df.dtypes)


def confirmed_one_by_one(lines, pairs):
    sets = [{line[i : i + 12] for i in range(len(line) - 11)} for line in (x.strip().lower() for x in lines)]
    return {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}


def test_shingles_of_one_byte_characters_are_those_of_the_pattern(spark):
    lines = ["a", " Twelve chars ", "\tABC def\x0bGHI jkl MNO\r", "aaaaaaaaaaaaaaaaaaaa", "a\x00b" * 6, "ÄÖÜ äöü ß İıI xyz abc", "a😀b😀c😀d😀e😀f😀g😀h"]
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    plain = F.trim(F.translate(F.lower("line"), "\t\r\f\x0b", "    "))
    place = F.explode(F.sequence(F.lit(1), F.greatest(F.length("plain") - 11, F.lit(1))))
    pieces = rows.select("line", plain.alias("plain")).select("line", "plain", place.alias("at"))
    wanted = pieces.groupBy("line").agg(F.collect_set(F.xxhash64(F.substring("plain", F.col("at"), F.lit(12)))).alias("s"))
    wanted = {r["line"]: sorted(r["s"]) for r in wanted.collect()}
    assert {r["line"]: r["s"] for r in rows.select("line", line_dedup.shingle_hashes(F.col("line")).alias("s")).collect()} == wanted


def test_signatures_are_counted_slice_by_slice(spark, monkeypatch):
    stored = stored_by(spotsigs, monkeypatch)
    rows = [(i, sorted({7, -8, 100 + i // 3, *range(1000 * i, 1000 * i + 40)})) for i in range(9)] + [(9, [])]
    found = spotsigs._shared(spark.createDataFrame(rows, "rep long, signatures array<long>")).collect()
    of = {s: [i for i, r in rows if s in r] for _, r in rows for s in r}
    assert sorted(tuple(r) for r in found) == sorted((i, len(rows[i][1]), s, len(of[s])) for s in of for i in of[s] if len(of[s]) > 1)
    assert len(stored) == spotsigs.SLICES > 1
    assert all(len({r["signature"] % spotsigs.SLICES for r in df.collect()}) <= 1 for df in stored)


def test_lines_and_documents_without_a_like_are_not_moved(spark, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    twin = "this line stands in two documents as it is, or nearly so"
    texts = [f"{i} is {i * 7919 % 1000} not {i * 104729 % 99991} like {i * 15485863 % 9999991} any" for i in range(200)]
    texts += [twin, twin + "!", twin, None, ""]
    docs = spark.createDataFrame([(i if i != 200 else None, x) for i, x in enumerate(texts)], "doc_id long, text string")
    stored, lines = [], line_dedup.durable
    monkeypatch.setattr(line_dedup, "durable", lambda df: stored.append(df) or lines(df))
    out = line_dedup.drop_repeated_lines(docs)
    texts_moved = next(df for df in stored if df.columns == ["line_key", "line"])
    for moved in (texts_moved, out):
        plan = moved._jdf.queryExecution().optimizedPlan().toString()
        assert "scalar-subquery" in plan.split("Join", 1)[1]
    assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == sorted(
        (str(i if i != 200 else None), "" if i in (201, 202) else x) for i, x in enumerate(texts)
    )
