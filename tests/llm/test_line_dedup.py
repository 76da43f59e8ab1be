from tillmark.llm import line_dedup

WORD_ENDS = "\x20\x09\x0a\x0b\x0c\x0d"


def brute(docs: dict[int, str], min_words: int) -> dict[int, str]:
    """Every run of lines with enough words that also starts earlier, tried one by one."""
    seqs = {d: [(i, x) for i, x in enumerate(t.split("\n")) if x.strip(WORD_ENDS)] for d, t in docs.items()}
    seen, gone = {}, {d: set() for d in docs}
    for d in sorted(docs):
        lines = [x for _, x in seqs[d]]
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(len(x.split()) for x in lines[a:b]) >= min_words:
                    run = tuple(lines[a:b])
                    if run in seen:
                        gone[d].update(seqs[d][i][0] for i in range(a, b))
                    else:
                        seen[run] = (d, a)
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in docs.items()}


def kept(docs, min_words=5):
    return {r["row"]["doc_id"]: r["kept_text"] for r in line_dedup.dedup_lines(docs, min_words).collect()}


def test_matches_brute_force(docs_of):
    import random

    rng = random.Random(5)
    pool = ["one two", "three", "four five six seven", "", " ", "eight nine", "ten\t", "a b c d e f"]
    texts = {d: "\n".join(rng.choice(pool) for _ in range(rng.randrange(12))) for d in range(40)}
    for min_words in (1, 5, 9):
        assert kept(docs_of(*texts.items()), min_words) == brute(texts, min_words)


def test_short_lines_go_only_within_a_longer_run(docs_of):
    texts = {1: "yes\nof course not\nI see now", 2: "yes\nelse", 3: "new\nyes\nof course not\nI see now"}
    assert kept(docs_of(*texts.items())) == {1: texts[1], 2: texts[2], 3: "new"}


def test_hard_rows(docs_of):
    same = "five words on one line"
    got = line_dedup.dedup_lines(docs_of(
        (1, None), (2, ""), (3, "\n \n"), (4, same), (4, same), (5, same + "\n\nrest"), (None, same),
        (6, (same + "\n") * 3000))).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r["row"]["doc_id"], []).append(r)
    assert by_id[1][0]["kept_text"] is None and by_id[1][0]["n_lines"] == 0
    assert by_id[2][0]["kept_text"] == "" and by_id[3][0]["kept_text"] == "\n \n"
    assert [r["kept_text"] for r in by_id[None]] == [same]  # a null id comes first
    assert [r["kept_text"] for r in by_id[4]] == ["", ""]
    assert by_id[5][0]["kept_text"] == "\nrest" and by_id[5][0]["n_removed"] == 1
    assert by_id[6][0]["n_removed"] == 3000 and by_id[6][0]["copied_lines"] == 2048
    assert line_dedup.dedup_lines(docs_of()).count() == 0


def test_runs_name_their_source(docs_of):
    run = ["alpha beta gamma", "delta epsilon zeta", "eta theta iota"]
    docs = docs_of((1, "\n".join(["first line here", *run, "end of one"])), (2, "\n".join(["start", *run])))
    found = line_dedup.repeated_runs(line_dedup.suffix_names(docs)).collect()
    assert [tuple(r) for r in found] == [(2, 1, 3, 1, 1)]


def test_query_and_sql_agree_on_long_copied_runs(spark, tmp_path):
    import duckdb

    from tillmark.llm.queries import ORACLES, QUERIES

    text = "\n".join(f"line {i} of a long text" for i in range(2100))
    rows = [(1, text), (2, "own line of the second text\n" + text), (3, None), (4, "short")]
    made = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' lang", "'s' source", "CAST(length(text) AS bigint) n_chars")
    made.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    columns = "doc_id, n_lines, n_removed, n_runs, copied_lines, kept_sha256"
    got = QUERIES["op1_line_dedup"](spark, str(tmp_path)).selectExpr(*columns.split(", "))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT {columns} FROM ({ORACLES['op1_line_dedup']})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert {r[4] for r in want if r[0] == 2} == {2048}


def test_one_word_lines_in_long_runs(docs_of):
    """Runs that count only as a whole: no stretch of a power of two of their lines does."""
    import random

    rng = random.Random(9)
    pool = ["a", "b", "c", "d e", "f g h i j", "", "k"]
    texts = {d: "\n".join(rng.choice(pool) for _ in range(rng.randrange(40))) for d in range(30)}
    texts[30] = texts[7] + "\nz\n" + texts[3]
    for min_words in (3, 5, 7, 12):
        want = brute(texts, min_words)
        rows = line_dedup.dedup_lines(docs_of(*texts.items()), min_words).collect()
        assert {r["row"]["doc_id"]: r["kept_text"] for r in rows} == want
        assert sum(r["n_runs"] for r in rows) > 10


def test_runs_are_counted(docs_of):
    a, b = "five words are in here\nand", "five more words stand there"
    rows = line_dedup.dedup_lines(docs_of((1, f"{a}\n{b}"), (2, f"{a}\nown\n\n{b}"), (3, f"{a}\n\n{b}"))).collect()
    assert {r["row"]["doc_id"]: (r["n_removed"], r["n_runs"], r["kept_text"]) for r in rows} == {
        1: (0, 0, f"{a}\n{b}"), 2: (3, 2, "own\n"), 3: (3, 1, "")}


def test_a_long_copy_makes_no_more_rows_than_lines(docs_of):
    text = "\n".join(f"line {i} of a long text" for i in range(5000))
    docs = docs_of((1, text), (2, "first line of the second text\n" + text))
    decided = line_dedup._decided(line_dedup.suffix_names(docs), 5).collect()
    assert [(r["doc"], r["gone"], r["copied"]) for r in decided] == [(2, list(range(1, 5001)), 4096)]


def test_plan_is_native(docs_of):
    plan = line_dedup.dedup_lines(docs_of((1, "a b c d e"), (2, "a b c d e")))._jdf.queryExecution().toString()
    for python in ("ArrowEval", "BatchEvalPython", "MapInArrow", "MapInPandas", "PythonUDF"):
        assert python not in plan
