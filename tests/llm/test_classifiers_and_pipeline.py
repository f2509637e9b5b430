import math
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelmill.llm import decontam, quality, registry, sharding, toxicity
from tests.llm.fixtures import DOCS, awkward, frame, words

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def _accuracy(spark, name, label):
    rows = registry.QUERIES[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    held = rows.where("held_out").select("predicted", F.col(label).alias("label"), "score").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in held)
    return sum(r.predicted == r.label for r in held) / len(held)


def test_held_out_accuracy(spark):
    assert _accuracy(spark, "op1_quality_rules", "quality") > 0.97
    assert _accuracy(spark, "op5_toxicity", "toxic") > 0.93


def test_rules_are_sparse_and_compiled_as_told(spark):
    draw = random.Random(2)
    texts = [(i, " ".join(words(i, 50)) if i % 2 else " ".join(f"{w}!!" for w in words(i, 50))) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2, None) for i, _ in texts] + [(0, None, 1), (1, 1, 0), (None, 1, 1)], LABELS)
    docs = frame(spark, texts + [(500 + i, t) for i, t in awkward() if i])
    model = quality.fit(docs, labels)
    assert 0 < len(model.rules) < 60
    for r in quality.score(docs, model, name="p").collect():
        stats = quality.statistics((r.text or "").encode())
        total = model.intercept + sum(
            x.weight for x in model.rules if all(low < stats[k] <= high for k, low, high in x.bounds))
        assert math.isclose(r.p, 1 / (1 + math.exp(-total)), rel_tol=1e-9)
        if r.doc_id < 500:
            assert (r.p >= 0.5) == bool(r.doc_id % 2)
    assert draw


def test_statistics_for_the_fit_are_made_in_many_tasks(spark, monkeypatch):
    parts, stage = {}, quality.stage

    def told(df, name):
        # Tasks that run the statistics in what is staged here.
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        parts[name] = ("MapInArrow" in plan, df.rdd.getNumPartitions())
        return stage(df, name)

    monkeypatch.setattr(quality, "stage", told)
    texts = [(i, " ".join(words(i, 20))) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, None) for i, _ in texts], LABELS)
    quality.fit(frame(spark, texts), labels)
    assert [n for made, n in parts.values() if made] == [spark.sparkContext.defaultParallelism]


@pytest.mark.parametrize("rows", [[], [(1, 1, 1), (2, 1, 1)], [(1, None, None)]])
def test_few_labels_give_constant_or_preset_scores(spark, rows):
    docs, labels = frame(spark, awkward()), spark.createDataFrame(rows, LABELS)
    got = quality.score(docs, quality.fit(docs, labels), name="p").select("p").distinct().collect()
    assert len(got) == 1 and 0 <= got[0].p <= 1
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(scored) == len(awkward()) and all(0 <= r.score <= 1 for r in scored)
    empty = frame(spark, [])
    assert quality.score(empty, quality.fit(empty, labels), name="p").count() == 0
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = {"idiot": 2.0, "moron": 3.0, "scum": 4.0, "clown": 5.0}
    automaton = toxicity.Automaton(toxicity.Lexicon(terms, {"réeux": 1.5}, frozenset({"clowns"})))
    draw = random.Random(4)
    for _ in range(4000):
        word = list(draw.choice(list(terms)))
        for _ in range(draw.randint(0, 2)):
            at = draw.randrange(len(word) + 1)
            word[at:at + draw.randint(0, 1)] = draw.choice(["", "x", "o", "i"])
        word = "".join(word)
        weight, edits = automaton.match(word)
        near = [w for t, w in terms.items() if len(t) >= 5 and _distance(t, word) == 1]
        if word in terms:
            assert (weight, edits) == (terms[word], 0)
        elif near and word != "clowns":
            assert (weight, edits) == (max(near), 1)
        else:
            assert (weight, edits) == (0.0, 0)
    assert automaton.match("réeuxment") == (1.5, 0) and automaton.match("clowns") == (0.0, 0)


def test_misspelled_stems_are_hits_unless_ordinary():
    stems = {"réeuka": 1.5, "bomest": 2.0, "bomed": 2.5, "achl": 3.0}
    automaton = toxicity.Automaton(toxicity.Lexicon({}, stems, frozenset({"bomestal", "bemest"})))
    draw = random.Random(5)
    for _ in range(4000):
        word = list(draw.choice(list(stems)) + draw.choice(["", "ta", "ment"]))
        for _ in range(draw.randint(0, 2)):
            at = draw.randrange(len(word) + 1)
            word[at:at + draw.randint(0, 1)] = draw.choice(["", "x", "o", "é"])
        word = "".join(word)
        exact = [w for t, w in stems.items() if word.startswith(t)]
        near = [w for t, w in stems.items() if len(t) >= 6 and t[0] == word[:1] and any(_distance(t, word[:k]) == 1 for k in range(len(word) + 1))]
        if word not in ("bomestal", "bemest"):
            assert automaton.match(word) == ((max(exact), 0) if exact else (max(near), 2) if near else (0.0, 0)), word
    assert automaton.match("bomestal") == automaton.match("bemest") == (0.0, 0)
    assert automaton.match("bomestta") == (2.0, 0) and automaton.match("bemestta") == (2.0, 2)


def test_the_automaton_forgets_states_without_a_change(monkeypatch):
    lexicon = toxicity.Lexicon({"idiot": 2.0, "moron": 3.0}, {"varulka": 1.0})
    draw, plain = random.Random(6), toxicity.Automaton(lexicon)
    monkeypatch.setattr(toxicity, "_STATES", 12)
    small = toxicity.Automaton(lexicon)
    for _ in range(500):
        word = "".join(draw.choice("idotmrnvaulk") for _ in range(3)) + draw.choice(["idiot", "moron", "varulka"])[:draw.randint(2, 7)]
        assert small.match(word) == plain.match(word)
        assert len(small.members) < 12 + 40


def test_words_like_a_stem_are_counted_apart():
    automaton = toxicity.Automaton(toxicity.Lexicon({"idiot": 3.0}, {"varulka": 2.0}))
    alike = toxicity.features("a vorulkazz here", automaton)
    assert alike[:6] == [0.0] * 6 and alike[6] > 0
    assert toxicity.features("a varulkazz here", automaton)[0] > 0


def test_misspelled_learned_terms_are_found(spark):
    texts = [(i, " ".join(words(i, 30) + (["grumkolb", "varulka" + "abcdef"[i % 6] * 2] if i % 2 else ["grumset"])))
             for i in range(200)]
    labels = spark.createDataFrame([(i, None, i % 2) for i, _ in texts], LABELS)
    lexicon = toxicity.fit(frame(spark, texts), labels).lexicon
    assert "grumkolb" in lexicon.words and any("varulka".startswith(x) for x in lexicon.stems)
    automaton = toxicity.Automaton(lexicon)
    for word in ("grumkilb", "grmkolb", "grumkkolb", "vorulkazz", "varrulkazz", "vrulkazz"):
        assert automaton.match(word)[0] > 0, word
    assert automaton.match("grumset") == (0.0, 0)


def test_quotation_counts_less_than_abuse():
    automaton = toxicity.Automaton(toxicity.Lexicon({"idiot": 3.0, "moron": 3.0}))
    plain = toxicity.features("you idiot you moron go away now", automaton)
    quoted = toxicity.features('he wrote "you idiot you moron" go away now', automaton)
    assert 0 < quoted[3] < plain[3] and 0 < quoted[0] < plain[0]
    # Over any length and line breaks; marks behind numbers or inside words open nothing.
    for gap in ("\n", " thing" * 500, " thing\n" * 500):
        for a, b in ('""', "“”", "«»", "„“"):
            told = toxicity.features(f"they {a}you idiot{gap} you moron{b} go away", automaton)
            bare = toxicity.features(f"they you idiot{gap} you moron go away", automaton)
            assert told[0] == quoted[0] < bare[0]
    assert toxicity.features('5" you idiot you moron 6" go away now', automaton)[0] == plain[0]


def test_whole_score_equals_plain_arithmetic(spark):
    texts = [(i, t) for i, (_, t) in enumerate(awkward())] + [
        (100, "you idiot " * 50), (101, 'he said "idiot" and left'), (102, "idiott vorulkazz word moron"), (103, "word " * 90 + "moron")]
    model = toxicity.ToxicityModel(toxicity.Lexicon({"idiot": 3.0, "moron": 2.0}, {"varulka": 1.0}), -2.0, (1.0, 0.5, 0.25, 0.75, 0.1, 0.3, 0.2))

    def plain(text):
        words = re.findall(r"\w+", text.lower())
        kinds = {}
        for i, w in enumerate(words):
            one = [v for t, v in model.lexicon.words.items() if _distance(t, w) == 1]
            if w in model.lexicon.words or w.startswith("varulka"):
                kinds[i] = (model.lexicon.words.get(w, 1.0), 0)
            elif one:
                kinds[i] = (max(one), 1)
            elif w[0] == "v" and any(_distance("varulka", w[:k]) == 1 for k in range(len(w) + 1)):
                kinds[i] = (1.0, 2)
        inside = [m.span() for m in re.finditer(r'(?<!\w)"[^"]+"(?!\w)', text.lower())]
        places = [m.start() for m in re.finditer(r"\w+", text.lower())]
        parts = {i: 0.3 if any(a <= places[i] < b for a, b in inside) or set(words[max(0, i - 4):i]) & toxicity.REPORTING else 1.0
                 for i, (_, k) in kinds.items() if k < 2}
        heavy = {i: kinds[i][0] * p * (0.7 if kinds[i][1] else 1.0) for i, p in parts.items()}
        window = max((sum(w for j, w in heavy.items() if i - 40 < j <= i) for i in heavy), default=0.0)
        values = [sum(p for i, p in parts.items() if kinds[i][1] == 0), sum(p for i, p in parts.items() if kinds[i][1] == 1),
                  sum(heavy.values()), window, 100 * sum(parts.values()) / max(len(words), 1), len({words[i] for i in parts}),
                  len(kinds) - len(parts)]
        return 1 / (1 + math.exp(-(model.intercept + sum(w * math.log1p(v) for w, v in zip(model.weights, values)))))

    got = {r.doc_id: r.score for r in toxicity.score(frame(spark, texts), model).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        assert math.isclose(got[i], plain(text or ""), rel_tol=1e-9), i


def test_labels_that_nothing_tells_apart(spark):
    texts = [(i, "one short text") for i in range(3)]
    labels = spark.createDataFrame([(0, 1, 1), (1, 0, 0), (2, 1, 1)], LABELS)
    docs = frame(spark, texts)
    assert {round(r.p, 6) for r in quality.score(docs, quality.fit(docs, labels), name="p").collect()} == {round(2 / 3, 6)}
    many = [(i, " ".join(words(i, 30))) for i in range(300)]
    docs, labels = frame(spark, many), spark.createDataFrame([(i, int(i > 0), 0) for i, _ in many], LABELS)
    assert quality.score(docs, quality.fit(docs, labels), name="p").count() == 300
    with pytest.raises(ValueError, match="already has a column"):
        quality.score(docs, quality.RuleModel(0.0))


def test_repeated_ids_do_not_widen_the_fit(spark):
    texts = [(7, f"row {i}") for i in range(3000)] + [(8, "another"), (None, "no id")]
    drawn = quality.draw_labels(spark.createDataFrame([(7, 1, 1), (8, 0, 0), (None, 1, 1)], LABELS), "toxic", None, 20_000)
    rows = quality.labelled_texts(frame(spark, texts), drawn, "doc_id", "text").collect()
    assert sorted((r.target, r.text) for r in rows) == [(0.0, "another"), (1.0, "row 0")]


def test_shards_equal_brute_force(spark):
    texts = awkward() + [(1000 + i, "x" * (i % 37)) for i in range(300)]
    got = sharding.assign_shards(frame(spark, texts), 7).collect()
    assert len(got) == len(texts)
    size = lambda t: len((t or "").encode()) + 1
    total, by = sum(size(t) for _, t in texts), {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    most = max(size(t) for _, t in texts)
    for rows in by.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert sum(r.size for r in rows) <= total / 7 + most
    order = [(r.doc_id is not None, r.doc_id or 0) for s in sorted(by) for r in sorted(by[s], key=lambda r: r.slot)]
    assert order == sorted(order)
    assert sharding.assign_shards(frame(spark, []), 7).count() == 0


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = frame(spark, [(i, f"text {i}") for i in range(50)]).select("doc_id", "text")
    sharding.write_shards(docs, sharding.assign_shards(docs, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and back.select("shard").distinct().count() == 4


def _items():
    return [(f"b{i}", " ".join(words(900 + i, 40))) for i in range(6)]


def _benchmark(spark):
    return spark.createDataFrame(_items() + [(None, "tiny pair"), ("e", ""), ("n", None)], "item_id string, text string")


def test_edited_copies_are_found_and_clean_texts_stay(spark):
    draw, items = random.Random(6), _items()
    texts = []
    for i, (_, item) in enumerate(items):
        filler = words(50 + i, 200)
        cut = item.split()
        for k in draw.sample(range(len(cut)), 6):
            cut[k] = "edited"
        del cut[20:22]
        texts += [(i, " ".join(filler[:80] + [item.upper()] + filler[80:])), (10 + i, " ".join(filler[:80] + cut + filler[80:])),
                  (20 + i, " ".join(filler + cut[:6]))]
    texts += [(None, "A tiny, pair."), (40, None), (41, "tiny other pair")]
    found = decontam.matches(frame(spark, texts), _benchmark(spark)).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == {(k + i, f"b{i}") for i in range(6) for k in (0, 10)} | {(None, None)}
    whole = {r.doc_id: r for r in found if r.doc_id is not None}
    for i, (_, item) in enumerate(items):
        r = whole[i]
        assert math.isclose(r.score, 1) and dict(texts)[i][r.first_char:r.end_char].lower() == item.lower()
    left = decontam.clean(frame(spark, texts), _benchmark(spark))
    assert left.columns == [f.name for f in DOCS.fields]
    assert sorted(r.doc_id for r in left.collect()) == [20, 21, 22, 23, 24, 25, 40, 41]


def test_matches_equal_the_alignment_of_all_pairs(spark):
    draw, items, texts = random.Random(11), _items(), []
    for n, share in enumerate((0.1, 0.2, 0.3, 0.4, 0.6)):
        for i, (_, item) in enumerate(items):
            cut = item.split()
            for k in draw.sample(range(len(cut)), int(share * len(cut))):
                cut[k] = draw.choice(["edited", "", "two more"])
            filler = words(300 + 10 * n + i, 120)
            texts.append((100 * n + i, " ".join(filler[:60] + cut + filler[60:])))
    # Every third word edited: no three words in a row are left.
    texts += [(900 + i, " ".join(w if k % 3 else "edited" for k, w in enumerate(item.split()))) for i, (_, item) in enumerate(items)]
    known = decontam.read_items(items)
    want = {}
    for doc, text in texts:
        for k, item in enumerate(known.words):
            score = decontam.align(known.numbers(text), item)[0] / len(item)
            if score >= decontam.LEAST - 1e-9:
                want[doc, known.ids[k]] = round(score, 9)
    got = {(r.doc_id, r.item_id): round(r.score, 9) for r in decontam.matches(frame(spark, texts), _benchmark(spark)).collect()}
    assert got == want
    assert len([d for d, _ in want if d < 400]) >= 0.9 * 24 and len([d for d, _ in want if d >= 900]) == 6


def test_decontamination_in_parts_and_of_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PART", 50)
    docs = frame(spark, [(i, item) for i, (_, item) in enumerate(_items())])
    assert decontam.matches(docs, _benchmark(spark)).select("doc_id").distinct().count() == 6
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontam.matches(docs, none).count() == 0 and decontam.clean(docs, none).count() == 6
    assert decontam.matches(frame(spark, []), _benchmark(spark)).count() == 0


def test_alignment_equals_plain_smith_waterman():
    import numpy as np

    draw = random.Random(8)
    for _ in range(200):
        a = np.array([draw.randint(-1, 5) for _ in range(draw.randint(1, 25))])
        b = np.array([draw.randint(0, 5) for _ in range(draw.randint(1, 15))])
        table = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = max(0, table[i][j] + (decontam.AGREE if x == y else decontam.DIFFER),
                                          table[i][j + 1] + decontam.DIFFER, table[i + 1][j] + decontam.DIFFER)
        assert math.isclose(decontam.align(a, b)[0], max(map(max, table)), abs_tol=1e-9)


def test_pipeline_stages_one_by_one(spark, tmp_path):
    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), None
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for k, (name, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "quality_classifier":
            bad = [i for i in ids if labels.get(i) == 0]
            good = [i for i, q in labels.items() if q == 1]
            assert len(bad) <= 2 and len(ids.intersection(good)) >= 0.99 * len(good)
        if name == "exact_dedup":
            assert docs.select("text").distinct().count() == docs.count()
        if name == "decontaminate":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert not any(item in r.text for r in docs.collect() for item in items)
        assert before is None or ids <= before
        before = ids
    assert docs.where("NOT round_trip").count() == 0
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


@pytest.mark.parametrize("stage_no", range(5))
def test_pipeline_stages_take_awkward_rows(spark, stage_no):
    name, function = corpus_pipeline.STAGES[stage_no]
    out = function(spark, frame(spark, awkward()), SF)
    assert 0 < out.count() <= len(awkward()) and function(spark, frame(spark, []), SF).count() == 0
