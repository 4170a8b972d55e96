import json
import threading

import pytest
from pyspark.sql import functions as F

from millrace.model import client as C
from millrace.model import stages as M


class Fake:
    """Answers every item but those with ``skip`` in their text, which it answers when they are asked for alone."""

    def complete(self, prompt, max_tokens):
        items = json.loads(prompt.split("\n", 1)[1])
        if any("boom" in i["text"] for i in items):
            raise C.Congested("503")
        if any("long" in i["text"] for i in items) and max_tokens < 5000:
            return C.Answer("[", truncated=True)
        rows = [{"id": str(i["id"]), "label": "qa"} for i in items if "skip" not in i["text"] or len(items) == 1]
        return C.Answer(f"```json\n{json.dumps(rows)}\n```", prompt_tokens=10, completion_tokens=5, model="m")


class Broken:
    def complete(self, prompt, max_tokens):
        return C.Answer("no json")


def items(spark, rows):
    df = spark.createDataFrame(rows, "doc string, pos long, text string")
    return M.batched(df, "doc", ["pos"], F.col("text"), 3, 100)


def test_stage_with_repair_and_defaults(spark):
    made = items(spark, [("a", 0, "x"), ("a", 1, "skip me"), ("a", 2, "y"), ("a", 3, "long"), ("b", 0, "boom")])
    done, log = M.stage(made, "label these", F.col("text"), "label string", {"label": "none"}, Fake)
    got = {(r["doc"], r["pos"]): (r["answered"], r["label"]) for r in done.collect()}
    assert got == {("a", 0): (True, "qa"), ("a", 1): (True, "qa"), ("a", 2): (True, "qa"), ("a", 3): (True, "qa"), ("b", 0): (False, "none")}
    told = {r["model"]: r for r in M.usage(log).collect()}
    assert told["m"]["calls"] == 3 and told["m"]["prompt_tokens"] == 30 and told[""]["failed"] == 2


def test_bad_output_is_an_error(spark):
    log = M.ask(spark.createDataFrame([("k", "p\n[]")], "batch_key string, prompt string"), Broken).collect()
    assert log[0]["row"] is None and "invalid json" in log[0]["error"]


def test_cache_asks_only_for_the_new(spark):
    one = M.prompts_of(items(spark, [("a", 0, "x")]), "h", F.col("text"))
    asked, new = M.with_cache(one, None, Fake, "v1")
    assert asked.count() == 1 and new.count() == 1
    both = M.prompts_of(items(spark, [("a", 0, "x"), ("b", 0, "y")]), "h", F.col("text"))
    every, fresh = M.with_cache(both, new, Fake, "v1")
    assert every.count() == 2 and [r["batch_key"] for r in fresh.collect()] == ["b#0"]


UNITS = "key long, query string, answer string, truncated boolean, paraphrases array<string>"


def test_review_rounds(spark):
    units = spark.createDataFrame([(1, "q1", "good", False, ["a", "b"]), (2, "q2", "bad", False, []), (3, "q3", "worse", False, []), (4, "q4", "unknown", False, [])], UNITS)

    def review(u):
        verdict = F.when(F.col("answer").isin("good", "bad!"), "pass").when(F.col("answer") == "unknown", None).otherwise("revise")
        return M.reviewed(u, u.select("key", verdict.alias("verdict"), F.array(F.lit("b")).alias("valid")))

    got = {r["key"]: r for r in M.review_rounds(units, review, lambda u: u.withColumn("answer", F.concat("answer", F.lit("!")))).collect()}
    assert [(got[k]["publication_status"], got[k]["review_attempts"]) for k in (1, 2, 3, 4)] == [("approved", 0), ("approved", 1), ("failed_review", 2), ("pending", 0)]
    assert got[1]["paraphrases"] == ["b"] and got[4]["needs_review"] and not got[3]["needs_review"]


def test_chain_falls_back_and_forgets_the_spent():
    calls = []

    class One:
        def __init__(self, name, error=None):
            self.name, self.error = name, error

        def complete(self, prompt, max_tokens):
            calls.append(self.name)
            if self.error:
                raise self.error
            return C.Answer("ok", model=self.name)

    chain = C.Chain({"a": One("a", C.Quota("quota")), "b": One("b")}, sleep=lambda s: None)
    assert chain.complete("p", 1).model == "b" and chain.complete("p", 1).model == "b" and calls == ["a", "b", "b"]
    blocked = C.Chain({"a": One("a", C.Blocked("x")), "b": One("b")}, sleep=lambda s: None)
    with pytest.raises(C.Blocked):
        blocked.complete("p", 1)
    slow = C.Chain({"a": One("a", C.Congested("429", 99.0))}, retries=2, sleep=calls.append)
    with pytest.raises(C.Congested):
        slow.complete("p", 1)
    assert 30.0 in calls and slow.windows["a"].size == 1


def test_window():
    w = C.Window(8)
    for _ in range(10):
        with w:
            pass
    assert w.size == 8
    with pytest.raises(C.Congested), w:
        raise C.Congested("429")
    assert w.size == 4
    peak, lock, chain = [0, 0], threading.Lock(), None

    class Slow:
        def complete(self, prompt, max_tokens):
            with lock:
                peak[0] += 1
                peak[1] = max(peak)
            threading.Event().wait(0.01)
            with lock:
                peak[0] -= 1
            return C.Answer("")

    chain = C.Chain({"a": Slow(), "b": Slow()}, limit=2)
    threads = [threading.Thread(target=chain.complete, args=("p", 1)) for _ in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert peak[1] <= 2 and chain.stats()["in_flight"] == 0


def test_errors():
    kinds = [type(C.error_of(*a)) for a in ((400, "Content Blocked"), (403, "insufficient_quota"), (429, "slow"), (500, "x"))]
    assert kinds == [C.Blocked, C.Quota, C.Congested, C.ModelError] and C.rejects_temperature(400, "bad Temperature")
    assert C.retry_delay(9, None, lambda: 0.5) == 10.0 and C.retry_delay(0, 99) == 30.0
