"""The operators of the llm subpackage on small tables, against brute force."""

import hashlib
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from bondscope.llm import chat, decontamination, exact_dedup, language, licenses, line_dedup, mixing, near_dedup, quality, toxicity

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, lang string, size int, n int"


@pytest.fixture(scope="module")
def docs(spark):
    base = [f"word{i * 7 % 31} tail{i}" for i in range(60)]
    text = " ".join(base)
    near = [" ".join(base[:i] + ["other"] + base[i + 1:]) for i in range(0, 60, 6)]
    rows = [text, text, " " + text, None, "", "one two", "one  two", "x" * 30_000, *near, "Mixed Case WORDS here now please"]
    table = [(i, t, None if i % 5 == 0 else f"s{i % 3}", "en", 1, 2) for i, t in enumerate(rows)]
    return spark.createDataFrame([*table, table[0]], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_groups(docs, empty):
    rows = docs.collect()
    groups = {}
    for r in rows:
        groups.setdefault(SPACE.sub("", r.text or ""), []).append((-len(r.text or ""), r.doc_id))
    for r in exact_dedup.exact_groups(docs).collect():
        text = next(SPACE.sub("", x.text or "") for x in rows if x.doc_id == r.doc_id)
        assert r.keep_id == min(groups[text])[1] and r.group_size == len(groups[text])
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert exact_dedup.exact_groups(empty).count() == 0


def test_live_index_deletes_and_grows():
    index = exact_dedup.LiveIndex(4)
    keys = [hashlib.sha256(bytes([i, j])).digest() for i in range(20) for j in range(50)]
    for i, key in enumerate(keys):
        index.add(key, 1, i, 1)
    assert all(key in index.filter for key in keys)
    assert all(index.remove(key) for key in keys[::2]) and not index.remove(keys[0])
    assert all(key in index.filter for key in keys[1::2]) and len(index.rows) == 500


def test_near_groups(docs, empty):
    sets = {}
    for r in docs.collect():
        w = near_dedup.words(r.text)
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for a, b in combinations(sets, 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    found = near_dedup.near_groups(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), label[r.doc_id])
    assert near_dedup.near_groups(empty).count() == 0


def test_mix_meets_targets(docs, empty):
    rows = mixing.mixed_documents(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert sorted(rows) == sorted(mixing.mixed_documents(docs).collect())
    assert mixing.mixed_documents(empty).count() == 0
    assert mixing.targets([10, 100, 100], [5, 2, 1], 210) == [30.0, 120.0, 60.0]


def test_permutation_is_one():
    import numpy as np
    for size in (1, 2, 5, 100, 4097):
        assert sorted(mixing.permuted(np.arange(size), size, 3)) == list(range(size))


def test_contaminated(spark, docs, empty):
    text = " ".join(f"tail{i} word{(i + 1) * 7 % 31}" for i in range(10, 18))
    bench = spark.createDataFrame([(1, text), (2, "one TWO"), (3, None), (4, "")], "item_id long, text string")
    items = {1: decontamination.words(text), 2: [b"one", b"two"]}
    texts = {r.doc_id: decontamination.words(r.text) for r in docs.collect()}
    for r in decontamination.contaminated(docs, bench).collect():
        w, hit, names = texts[r.doc_id], set(), set()
        for item, words in items.items():
            n = min(10, len(words))
            windows = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    names.add(str(item))
        assert (r.n_words, r.n_hit, r.n_items) == (len(w), len(hit), len(names))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    assert decontamination.contaminated(empty, bench).count() == 0
    assert not decontamination.contaminated(docs, bench.limit(0)).where("contaminated").count()


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "<|end|><|role|>x", "<\\|end|>", "[\\\\/INST] <", "", None, "a\nb\\"]
    table = [(c, i, "assistant" if i % 2 else "user", t) for c in (1, 2) for i, t in enumerate(texts * 20)]
    rows = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    source = "".join(f"{r}\n{t or ''}\n" for c, _, r, t in table if c == 1)
    loss = "".join(t or "" for c, _, r, t in table if c == 1 and r == "assistant")
    for r in chat.read_back(chat.formatted(rows)).collect():
        assert r.turns_sha256 == hashlib.sha256(source.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and r.loss_chars == len(loss)
    assert chat.formatted(rows.limit(0)).count() == 0


def test_toxicity_held_out(spark, empty):
    table = [(i, f"filler{i % 13} more{i % 7} " + ("vile nasty" if i % 4 == 0 else "kind"), i % 8 and 1, int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame(table, "doc_id long, text string, quality int, toxic int")
    labels = docs.where("doc_id < 200").select("doc_id", "quality", "toxic")
    found = {r.doc_id: r.toxic for r in toxicity.graded(docs, labels).collect()}
    assert all(found[i] == bool(t) for i, _, _, t in table)
    assert toxicity.graded(docs, labels.limit(0)).where("toxic").count() == 0
    assert toxicity.graded(empty, labels).count() == 0


def test_language(spark, empty):
    table = [(i, "the that with and this" if i % 2 else "der das und nicht eine", "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame([*table, (90, None, "en"), (91, "123", None)], "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in language.languages(docs, F.col("doc_id") > 20).collect()}
    assert all(found[i] == lang for i, _, lang in table) and found[90] == found[91] == "und"
    assert language.languages(empty, F.lit(False)).count() == 0


def test_lines_quality_licenses(spark, empty):
    table = [(i, f"Error {i} at host\nunique line {'abcdefghij'[i]} only {'klmnopqrst'[i]} here\nReleased under the MIT License.") for i in range(10)]
    docs = spark.createDataFrame([*table, (90, None), (91, "")], "doc_id long, text string")
    lines = {r.doc_id: r for r in line_dedup.without_recurring_lines(docs).collect()}
    assert lines[3].n_lines == 3 and "Error" not in lines[3].text_kept and lines[90].n_lines == 0
    found = {r.doc_id: r.licenses for r in licenses.scanned(docs, spark.createDataFrame(list(licenses.STATEMENTS), "license string, text string")).collect()}
    assert all(found[i] == "MIT" for i in range(10)) and found[90] == found[91] == ""
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    kept = quality.resampled(docs, labels)
    assert kept.count() == 12 and 5 <= kept.where("kept").count() <= 7
    assert line_dedup.without_recurring_lines(empty).count() == 0
    assert quality.resampled(empty, labels).count() == 0


def test_large_ids_beside_nulls(spark):
    """Ids beyond 2^53 in one batch with a null id come back as they are."""
    big = [2**60 + 1, 2**60 + 3, -(2**63)]
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(big[0], text), (None, "other words of one more text"), (big[1], text), (big[2], "x y")],
                                 "doc_id long, text string").coalesce(1)
    exact = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect()}
    assert exact == {big[0]: (big[0], 2, True), big[1]: (big[0], 2, False), big[2]: (big[2], 1, True), None: (None, 1, True)}
    near = {r.doc_id: (r.component_id, r.kept) for r in near_dedup.near_groups(docs).collect()}
    assert near[big[0]] == (big[0], True) and near[big[1]] == (big[0], False) and near[big[2]] == (big[2], True)
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    hit = {r.doc_id: r.contaminated for r in decontamination.contaminated(docs, bench).collect()}
    assert hit == {big[0]: True, big[1]: True, big[2]: False, None: False}


def test_drawn_blocks_are_not_broadcast(docs):
    pieces, _ = mixing.mix(docs)
    plan = pieces._jdf.queryExecution().toString()
    join = plan[plan.index("== Physical Plan"):]
    assert "SortMergeJoin [source_no" in join and "BroadcastHashJoin [source_no" not in join


def test_taken_words_come_near_the_target(spark):
    rows = [(i, " ".join(["w"] * (i % 90 + 1)), f"s{i % 7}") for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {}
    for i, text, source in rows:
        sizes[source] = sizes.get(source, 0) + i % 90 + 1
    names = sorted(sizes)
    wanted = mixing.targets([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(7)], sum(sizes.values()))
    taken = {}
    for r in mixing.mixed_documents(table).collect():
        source = rows[r.doc_id][2]
        taken[source] = taken.get(source, 0) + r.taken
        assert r.taken <= 3 * r["size"] and r.target == pytest.approx(wanted[names.index(source)])
    for name, goal in zip(names, wanted):
        assert abs(taken[name] - goal) <= 2 * 3 * mixing.BLOCK_WORDS


def test_lines_are_masked_and_split_once(spark, tmp_path):
    """Leaves and templates read stored lines; the text is not masked anew, and tokens are those of any white space."""
    lines = ["a b c d e 1", " a\tb  c\x0bd e x2y ", "a b\r c d e f", "", " \t ", "1 2 3", "no digit here at all"]
    rows = [(i, "\n".join(lines[i % 5:] + [f"own{i} line z"])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    mask = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
    plain = F.array_remove(F.split(F.regexp_replace("line", mask, "<*>"), r"[\x20\x09-\x0D]+"), "")
    assert cut.where(~plain.eqNullSafe(line_dedup.tokens(line_dedup.fields(F.col("line"))))).count() == 0
    found, path = [], line_dedup.handed_over

    def kept(df, name):
        found.append(name)
        return path(df, name)

    line_dedup.handed_over = kept
    try:
        out = line_dedup.without_recurring_lines(docs)
        result = {r.doc_id: r for r in out.collect()}
    finally:
        line_dedup.handed_over = path
    assert found == ["masked"]
    assert all("a b c d e 1" not in r.text_kept and "1 2 3" not in r.text_kept for r in result.values())
    assert all(result[i].text_kept.endswith("line z") or result[i].n_dropped for i in result)
