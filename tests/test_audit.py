import json
import random
import re

from pyspark.sql import functions as F

from sftq.functions.whitespace import unix_lines
from sftq.operators import audit as A
from sftq.plans.audit import audit_records, measure_records
from sftq.sources.jsonl import parse_records


def audited(spark, *rows):
    made = [(d, int(d[1:]), "train", i, json.dumps(x)) for d, i, x in rows]
    df = spark.createDataFrame(made, "dataset string, dataset_pos int, split string, i bigint, raw string")
    return audit_records(parse_records(df))


def plain(fmt, text, **more):
    return {"metadata": {"format": fmt, **more}, "messages": [{"role": "assistant", "content": text}]}


def by_category(cat, text):
    return {"category": cat, "subcategory": "", "messages": [{"role": "assistant", "content": text}]}


def counted(spark, fmt, text):
    df = spark.createDataFrame([(text,)], "t string")
    counts = A.escape_counts(F.col("t"), fmt)
    row = df.select(*[c.alias(n) for n, c in counts.items()]).first().asDict()
    return {k: v for k, v in row.items() if v}


def test_escape_counts(spark):
    assert counted(spark, "XML", "&amp;&#65;&#٣;&#xAf; & &x; <![CDATA[&lt;") == {
        "xml_amp": 1, "xml_num_dec": 2, "xml_num_hex": 1, "xml_bare_amp": 2, "xml_cdata": 1, "xml_lt": 1,
    }
    assert counted(spark, "JSON", '\\\\\\"\\u00e9\\u12\n\t\\n') == {
        "json_escaped_backslash": 1, "json_escaped_quote": 1, "json_escape_u": 1,
        "json_raw_control_char": 2, "json_escape_n": 1,
    }
    assert counted(spark, "CSV", 'a,"x\ny","" ""\n"z"') == {"csv_quote_doubled": 2, "csv_quoted_newline": 2}
    assert counted(spark, "YAML", "'it''''s' \\x41 \\U0001F600 \\u0041") == {
        "yaml_single_quote_doubled": 2, "yaml_escape_x": 1, "yaml_escape_U": 1, "yaml_escape_u": 1,
    }


def test_escape_counts_match_python(spark):
    rng = random.Random(5)
    atoms = ["\\", '"', "n", "b", "f", "r", "t", "u00e9", "x41", "U0001F600", "/", "'", "&", "amp;", "#1;", "\n", "\t", "é"]
    texts = ["".join(rng.choices(atoms, k=rng.randint(0, 25))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for fmt in A.ESCAPE_TEXTS:
        counts = A.escape_counts(F.col("t"), fmt)
        known = {n: re.escape(x) for n, x in A.ESCAPE_TEXTS[fmt].items()}
        known |= {n: p.replace(r"\p{Nd}", r"\d") for n, p in A.ESCAPE_PATTERNS[fmt].items()}
        for row in df.select("t", *[c.alias(n) for n, c in counts.items()]).collect():
            for name, pattern in known.items():
                assert row[name] == len(re.findall(pattern, row.t)), (name, row.t)


#: Lines and the inline tables in them: all, after an equals sign, as items of an array.
INLINE_LINES = [
    ("k = { a = 1 }", (1, 1, 0)),
    ("k =\t{ a = { b = 1 } }", (2, 2, 0)),
    ("x = [ { y = 2 }, { z = 3 } ]", (2, 0, 2)),
    ("x = [{ y = { q = 1 } }]", (2, 1, 1)),
    ('s = "{ a = 1 }"', (0, 0, 0)),
    ("s = '{ a = 1 }'", (0, 0, 0)),
    ('s = "quote \\" { a = 1 }"', (0, 0, 0)),
    ("e = {}", (0, 0, 0)),
    ("say ( { q = 1 } )", (1, 0, 0)),
    ('k = { a = "}" }', (1, 1, 0)),
    ("}", (0, 0, 0)),
    ("plain", (0, 0, 0)),
]


def test_inline_tables_of_composed_texts(spark):
    rng = random.Random(6)
    chosen = [[x] for x in INLINE_LINES] + [rng.choices(INLINE_LINES, k=rng.randint(0, 6)) for _ in range(800)]
    rows = [("\n".join(t for t, _ in parts), [sum(n[i] for _, n in parts) for i in range(3)]) for parts in chosen]
    rows += [("k = { a = 1 }\n{ b = 2", [1, 1, 0]), ('"abc\\', [0, 0, 0])]
    df = spark.createDataFrame(rows, "t string, want array<int>")
    for row in df.select("t", "want", A.toml_inline_tables(F.col("t")).alias("n")).collect():
        assert [row.n[c] or 0 for c in ("total", "after_eq", "in_array")] == row.want, repr(row.t)


def scanned(text):
    """Inline tables by a plain scan of characters: all, after an equals sign, as items of an array."""
    counts, stack, i = [0, 0, 0], [], 0
    while i < len(text):
        c = text[i]
        if c in "\"'":
            end = i + 1
            while end < len(text) and text[end] != c:
                end += 2 if c == '"' and text[end] == "\\" else 1
            i = end
        elif c == "{":
            stack.append(i)
        elif c == "}" and stack:
            start = stack.pop()
            if "=" in text[start:i]:
                lead = text[:start].rstrip()[-1:]
                for k, found in enumerate([True, lead == "=", lead != "" and lead in "[,"]):
                    counts[k] += found
        i += 1
    return counts


def test_inline_tables_of_random_texts(spark):
    rng = random.Random(8)
    atoms = ["{", "}", "=", " = ", "[", ",", ", ", '"', "'", "\\", "\n", "a", "\u2003", "{ a = 1 }", '"x = {"', "'}'", "[ {", "= {"]
    texts = ["".join(rng.choices(atoms, k=rng.randrange(1, 40))) for _ in range(6000)]
    texts += ["{" * 80 + "=" + "}" * 80, "x = " + "{ y = " * 70 + "1" + "}" * 70, "=" * 50_000 + "{=}", '"' + "\\n=" * 30_000 + '{" = {a=1}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", A.toml_inline_tables(F.col("t")).alias("n"), A.inline_fold(F.col("t"))["deep"].alias("deep")).collect()
    for row in rows:
        assert [(row.n and row.n[c]) or 0 for c in ("total", "after_eq", "in_array")] == scanned(row.t), repr(row.t[:200])
    assert sum(bool(r.deep) for r in rows) == 2


def test_headers_are_read_in_linear_time(spark):
    import time

    lines = ["[" + " " * 100_000 + "x", "[" + " " * 100_000 + "a . b ]  ", "[[ c ]]", "[[]", "[ ]", "[[d]", "[c.e]", "k = 1"]
    df = spark.createDataFrame([("\n".join(lines),)], "t string")
    df.select(A.toml_structure(F.col("t"))).collect()
    start = time.perf_counter()
    got = df.select(A.toml_structure(F.col("t")).alias("s")).first().s
    assert time.perf_counter() - start < 5
    assert (got.array_table_headers, got.table_headers, got.max_header_depth) == (2, 4, 2)



def test_toml_structure(spark):
    text = (
        "a = 1\n[x]\r\n[[ x . y ]]\n[x.y.z]\n[x.yy]\n [[q]] \n[q.r]\n[[]\n[ ]\nk = [1]\n"
        '[bad] # c\n[x.y]]\nj = "{\\"a\\": [1]}"\n'
    )
    df = spark.createDataFrame([(text,), ("",), ('s = """\n[1,\n 2]"""',), ('s = "[x"',)], "t string")
    df = df.withColumn("_s", A.toml_json_candidates(F.col("t"))).select(
        A.toml_structure(unix_lines(F.col("t"))).alias("s"), A.any_json(F.col("_s")).alias("j")
    )
    first, empty, long, none = df.collect()
    assert tuple(first.s) == (2, 1, 7, 3, 2)
    assert tuple(empty.s) == (0, 0, 0, 0, 0)
    assert [r.j for r in (first, empty, long, none)] == [True, False, True, False]


def test_long_strings_do_not_overflow(spark):
    text = 'x = "' + '{\\"a\\": 1}' * 100_000 + '"'
    df = spark.createDataFrame([(text,)], "t string").withColumn("_s", A.toml_json_candidates(F.col("t")))
    assert df.select(F.size("_s")).first()[0] == 1


def test_escape_report_is_dense(spark):
    df = audited(
        spark,
        ("d0", 0, plain("csv", 'a,"x""y"')),
        ("d0", 1, plain("csv", 'a\n"x""y",1')),
        ("d0", 2, {"x": 1}),
    )
    rows = {(r.format, r.escape_type): tuple(r)[3:] for r in A.escape_report(df).collect()}
    assert rows == {
        ("CSV", "csv_quote_doubled"): (2, 1, 2, 1, 2, 1),
        ("CSV", "csv_quoted_newline"): (2, 1, 0, 0, 0, 0),
        ("UNKNOWN", A.NO_CHECKS): (1, 0, 0, 0, 0, 0),
    }


def test_task_stats(spark):
    df = audited(
        spark,
        ("d1", 0, plain("json", "{")),
        ("d1", 1, plain("json", "[1")),
        ("d0", 7, plain("json", "[1")),
        ("d1", 2, plain("json", "{")),
        ("d1", 3, plain("json", "{}")),
        ("d1", 4, plain("csv", "a")),
    )
    for parts in (1, 8):
        csv, js = A.task_stats(df.repartition(parts)).collect()
        assert (csv.total, csv.errors, csv.usable_rate, csv.top_error) == (1, 0, "1.000000", "")
        assert (js.total, js.errors, js.usable, js.usable_rate) == (5, 4, 1, "0.200000")
        assert js.datasets == "d0;d1"
        assert js.top_error.startswith("parse_fail: Expecting ',' delimiter")


def test_rate_rounds_like_c(spark):
    df = spark.createDataFrame([(1 / 128,), (None,)], "x double")
    assert [r[0] for r in df.select(A.six_decimals(F.col("x"))).collect()] == ["0.007812", None]


def test_structure_stats_follow_the_first_family(spark):
    toml = '[[a.b]]\nx = "[1]"'
    df = audited(
        spark,
        ("d0", 0, plain("toml", toml)),
        ("d0", 1, by_category("C_TOML", toml)),
        ("d1", 0, by_category("C_TOML", toml)),
        ("d1", 1, by_category("C_TOML", "x")),
    )
    first, second = A.toml_structure_stats(df.where("output_format = 'TOML'")).collect()
    assert (first.family, first.examples_total, first.avg_array_table_headers) == ("u10bei", 2, 0.5)
    assert (first.max_header_depth_max, first.rate_json_stringified_like) == (2, 0.5)
    assert (second.examples_total, second.examples_usable, second.avg_table_headers) == (2, 1, None)


def test_sample_and_routes(spark):
    df = audited(spark, *[("d0", i, plain("toml", "k = { a = 1 }\n" * (i + 1))) for i in range(4)])
    assert [r.idx for r in A.inline_table_sample(df, rows=1).collect()] == ["0"]
    long = A.inline_table_sample(df, chars=5).first()
    assert (long.inline_table_count, long.payload_excerpt) == (1, "k = {")
    assert {(r.idx, r.status) for r in A.route_rows(df).collect()} == {("0", "usable")} | {(str(i), "errors") for i in (1, 2, 3)}


def test_filter_on_a_measure_parses_once(spark):
    df = audited(spark, ("d0", 0, plain("json", "{}"))).where("usable AND inline.total IS NULL")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("try_parse_json") <= 1


def test_usable_flag_of_callers(spark):
    df = spark.createDataFrame([("a\n1", "csv", "x")], "assistant_text string, output_format string, family string")
    assert measure_records(df).first().usable
