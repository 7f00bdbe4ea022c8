import random

import pytest
from pyspark.sql import functions as F

from exam_model import P, flat, run
from gleaner.operators.requirements import exam_requirements, flatten_optional, nest_optional

NB = "\u00a0"
VOCAB = [P.and_marker, P.or_marker, P.single_choice, P.group_choice, "07 Física e Química", "16 Matemática",
         "19 Matemática A", "x", NB + "02 Português" + NB, " 05 B", "Um dos seguintes conjuntos", P.and_marker + " "]


def _sequences(n=400, seed=7):
    rnd = random.Random(seed)
    return [[rnd.choice(VOCAB) for _ in range(rnd.randint(0, 12))] for _ in range(n)]


@pytest.mark.parametrize("mode", ["intended", "as_written"])
def test_matches_sequential_model(spark, mode):
    seqs = _sequences(400)
    rows = [(sid, t, text) for sid, toks in enumerate(seqs) for t, text in enumerate(toks)]
    df = spark.createDataFrame(rows, "sid long, token_no long, text string")
    opt, man = exam_requirements(df, ["sid"], "token_no", "text", mode)
    got_opt, got_man = {}, {}
    for r in opt.collect():
        got_opt.setdefault(r.sid, []).append((r.conjunct_no, r.group_no, r.pos, r.code, r.name))
    for r in man.collect():
        got_man.setdefault(r.sid, []).append((r.pos, r.code, r.name))
    bad = 0
    for sid, toks in enumerate(seqs):
        exp_opt, exp_man = flat(*run(toks, mode))
        if sorted(got_opt.get(sid, [])) != exp_opt or sorted(got_man.get(sid, [])) != exp_man:
            bad += 1
    assert bad == 0


def test_fixture_sequence(spark):
    toks = [P.single_choice, "07 Física e Química", P.or_marker, "16 Matemática", P.and_marker, "19 Matemática A"]
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(toks)], "sid long, token_no long, text string")
    opt, man = exam_requirements(df, ["sid"], "token_no", "text")
    assert sorted((r.conjunct_no, r.group_no, r.code) for r in opt.collect()) == [(0, 0, "07"), (0, 1, "16")]
    assert [(r.pos, r.code) for r in man.collect()] == [(0, "19")]


def test_group_choice_and_nesting_roundtrip(spark):
    toks = [P.group_choice, "02 A", "07 B", P.or_marker, "02 A", "16 C"]
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(toks)], "sid long, token_no long, text string")
    opt, _ = exam_requirements(df, ["sid"], "token_no", "text")
    nested = nest_optional(opt, ["sid"])
    got = nested.first()["optional"]
    assert [[[e["code"] for e in g] for g in c] for c in got] == [[["02", "07"], ["02", "16"]]]
    back = flatten_optional(nested, ["sid"])
    assert sorted(tuple(r) for r in back.drop("sid").collect()) == sorted(tuple(r) for r in opt.drop("sid").collect())
    assert back.filter(F.col("code") == "16").first()["group_no"] == 1
