import json
import sys
import tracemalloc

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sftq.catalog.judge import make_stub
from sftq.operators.judge import ask, checklist, judge, parse_judgement, resolve_attempts
from sftq.operators.validate import _parser_verdict
from sftq.plans.evaluate import evaluate_records


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def reply(text="", ok=True, error=None, done=None):
    return {"ok": ok, "text": text, "error": error, "raw": {"done_reason": done}}


def play(*replies):
    """Ask one prompt with scripted replies; returns the final text and the number of calls."""
    script = iter(replies)
    calls = []

    def scorer(prompts):
        calls.append(len(prompts))
        return [next(script) for _ in prompts]

    final = ask(scorer, ["p"])
    return final[0]["text"], len(calls)


def test_retries():
    good = '{"usable": true, "score": 1}'
    assert play(reply(good)) == (good, 1)
    assert play(reply("", done="load"), reply("words"), reply("more words")) == ("more words", 3)
    assert play(reply(""), reply(f" {good}\n")) == (f" {good}\n", 2)
    assert play(reply("", done="stop")) == ("", 1)
    assert play(reply("", ok=False, error="url_error: x"), reply(good)) == ("", 1)


def test_only_repeated_prompts_are_asked_again():
    asked = []

    def scorer(prompts):
        asked.append(list(prompts))
        return [reply("{}") if p == "a" or len(asked) > 1 else reply("no") for p in prompts]

    assert [r["text"] for r in ask(scorer, ["a", "b", "a", "c"])] == ["{}"] * 4
    assert asked == [["a", "b", "a", "c"], ["b", "c"]]
    assert ask(scorer, []) == []


BAD = "llm_json_parse_fail: "
#: Replies and what they must give: usable, score, rationale, error.
REPLIES = [
    ('{"usable": true, "score": 88, "rationale_en": "fine"}', (True, 88, "fine", None)),
    ('Sure: {"usable": "false", "score": " 90 ", "rationale_en": null} ok?', (True, 90, "", None)),
    ('{"usable": 0, "score": 87.9}', (False, 87, "", None)),
    ('{"usable": [], "score": "87.5"}', (False, 0, "", BAD + "invalid literal for int() with base 10: '87.5'")),
    ('{"usable": [0], "score": true, "rationale_en": ""}', (True, 1, "", None)),
    (
        '{"usable": 1}',
        (False, 0, "", BAD + "int() argument must be a string, a bytes-like object or a real number, not 'NoneType'"),
    ),
    ('{"score": 250}', (False, 100, "", None)),
    ('{"score": -5, "usable": NaN}', (True, 0, "", None)),
    ('{"score": 5, "score": 6}', (False, 6, "", None)),
    ('{"score": 5} trailing', (False, 0, "", BAD + "Extra data: line 1 column 14 (char 13)")),
    ("[1]", (False, 0, "", BAD + "'list' object has no attribute 'get'")),
    ('[{"score": 3}]', (False, 3, "", None)),
    ("}{", (False, 0, "", BAD + "Expecting value: line 1 column 1 (char 0)")),
    ("no json", (False, 0, "", BAD + "Expecting value: line 1 column 1 (char 0)")),
    ('{"a": ', (False, 0, "", BAD + "Expecting value: line 1 column 6 (char 5)")),
    (" \n ", (False, 0, "", "llm_empty_response")),
    ("", (False, 0, "", "llm_empty_response")),
    ('😀 {"score": 4, "usable": true} 😀', (True, 4, "", None)),
]


def test_judgements_of_known_replies(spark):
    df = spark.createDataFrame([(r,) for r, _ in REPLIES], "text string").withColumns(
        {"ok": F.lit(True), "error": F.lit(None).cast("string")}
    )
    for row in parse_judgement(df).collect():
        j = row.judgement
        assert (j.usable, j.score, j.rationale_en, j.error) == dict(REPLIES)[row.text], row.text
        assert j.raw_response == row.text.strip()


@pytest.mark.parametrize("size", [1, 3, 64])
def test_scorers_get_small_batches(spark, size):
    def make():
        def scorer(prompts):
            return [{"ok": True, "text": "{}", "error": None, "raw": {"eval_count": len(prompts)}} for _ in prompts]

        return scorer

    rows = spark.createDataFrame([(str(i) if i % 3 else None,) for i in range(30)], "p string").coalesce(1)
    out = rows.select("p", judge(F.col("p"), make, batch_size=size).alias("r")).collect()
    assert len(out) == 30
    sizes = [json.loads(x.r.raw)["eval_count"] for x in out if x.p is not None]
    assert len(sizes) == 20 and max(sizes) == min(size, 20)


def test_texts_are_unpacked_as_they_are_asked(spark):
    def make():
        tracemalloc.start()
        left = [600]

        def scorer(prompts):
            peak = tracemalloc.get_traced_memory()[1]
            left[0] -= len(prompts)
            if not left[0]:
                tracemalloc.stop()
            return [{"ok": True, "text": "{}", "error": None, "raw": {"eval_count": peak}} for _ in prompts]

        return scorer

    rows = spark.range(1000).coalesce(1).select(F.when(F.col("id") % 5 < 3, F.concat("id", F.repeat(F.lit("x"), 50_000))).alias("p"))
    out = rows.select(F.length("p").alias("n"), judge(F.col("p"), make).alias("r")).collect()
    assert len(out) == 1000 and all((r.n is None) == (r.r.ok is None) for r in out)
    peaks = [json.loads(r.r.raw)["eval_count"] for r in out if r.n is not None]
    assert len(peaks) == 600 and max(peaks) < 40 << 20  # Arrow's batch of 30 MB, 3 MB a call


def test_parsers_hold_one_text_at_a_time():
    payload = pa.array(['{"a": "%s"}' % ("x" * 100_000)] * 300 + [None, "{"])
    tracemalloc.start()
    try:
        got = _parser_verdict.func(pa.array(["JSON"] * 302), payload)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.field("ok").to_pylist() == [True] * 300 + [None, False]
    assert peak < 3 << 20  # 30 MB in all


def test_the_stub_forgets_what_it_has_answered():
    scorer = make_stub()
    tracemalloc.start()
    try:
        for k in range(50):
            prompts = [f"{k:04}{i:04}".ljust(10_000 + i % 2) for i in range(64)]
            replies = ask(scorer, [*prompts, prompts[0], prompts[1]])
            assert all(json.loads(r["text"])["score"] == len(p) % 101 for p, r in zip([*prompts, *prompts[:2]], replies, strict=True))
        prompts = replies = None
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 2 << 20  # 16 MB were asked twice


def test_failed_call_keeps_text_and_error(spark):
    df = spark.createDataFrame([(" x ", False, "http_error: 500")], "text string, ok boolean, error string")
    assert tuple(parse_judgement(df).first().judgement) == (False, 0, "", " x ", "http_error: 500")


def test_attempt_that_counts(spark):
    rows = [
        ("a", 0, True, "", "load"), ("a", 1, True, "x", None), ("a", 2, True, "", "load"),
        ("b", 0, False, "", None), ("b", 1, True, "{}", None),
        ("c", 0, True, "", None), ("c", 1, True, " {} ", "stop"),
        ("d", 0, True, "", "stop"), ("d", 1, True, "{}", None),
        ("e", 0, True, "x", None), ("e", 1, True, "y", None),
    ]
    df = spark.createDataFrame(rows, "record_id string, attempt int, ok boolean, text string, done_reason string")
    got = {r.record_id: r.attempt for r in resolve_attempts(df).collect()}
    assert got == {"a": 2, "b": 0, "c": 1, "d": 0, "e": 1}


def test_checklists(spark):
    df = spark.createDataFrame([("YAML",), (" yml",), ("ini",), (None,)], "f string")
    got = [r[0].split("\n")[0] for r in df.select(checklist(F.col("f"))).collect()]
    assert [x.startswith("Rubric (YAML 1.2)") for x in got] == [True, True, False, False]
    assert got[2] == got[3] and got[2].startswith("Rubric:")


def make_scorer():
    def scorer(prompts):
        if any("--- returned data ---" not in p for p in prompts):
            raise AssertionError("asked without an answer")
        return [
            {"ok": "fail" not in p, "error": "error: down" if "fail" in p else None,
             "text": '{"usable": true, "score": 91, "rationale_en": "r"}', "raw": {"eval_count": 3, "junk": 1}}
            for p in prompts
        ]

    return scorer


def test_evaluation(spark):
    rows = [
        (1, "q", 'Output:\n{"a": 1}', "json"),
        (2, "q", '{"a": 1', "json"),
        (3, "please fail", "a,b", "csv"),
        (4, "q", "", "toml"),
    ]
    df = spark.createDataFrame(rows, "id int, prompt string, output string, output_format string")
    df = df.withColumn("evaluation", F.lit("old"))
    for parts in (None, 3):
        got = {r.id: r.evaluation for r in evaluate_records(df, make_scorer, "m", partitions=parts).collect()}
        assert got[1].extraction.changed and got[1].llm.score == 91 and got[1].usable
        assert got[1].llm.meta.eval_count == 3 and got[1].llm.error is None
        assert got[2].llm.error == "skipped_due_to_grammar_error" and got[2].llm.meta is None
        assert not got[2].usable and got[2].llm.raw_response == ""
        assert got[3].llm.error == "error: down" and not got[3].usable
        assert got[4].extraction.sha1 == "" and got[4].usable
        assert got[1].timestamp.endswith("+00:00")
