"""The operators made of DataFrame functions alone: host rules, decontamination, mixing, chat."""

import itertools
import re

import pytest

from stratica.llm import chat, decontaminate, host_rules, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_masks_are_lossless():
    """Whichever two tokens of a window differ, a mask fits between them."""
    for size in range(3):
        for wrong in itertools.combinations(range(decontaminate.WINDOW), size):
            assert any(
                all(at + i not in wrong for i, bit in enumerate(mask) if bit == "1")
                for mask in decontaminate.MASKS
                for at in range(decontaminate.WINDOW - len(mask) + 1)
            )


CHINESE = "春天的花园里开满了红色和白色的小花朵"
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


@pytest.mark.parametrize(
    ("text", "found"),
    [
        (ITEM, True),
        ("Before it: " + ITEM.upper().replace(" ", "; ") + "!", True),
        (ITEM.replace("three", "x").replace("nine", "y") + " after", True),
        (ITEM.replace("three", "x").replace("nine", "y").replace("six", "z").replace("twelve", "q"), False),
        ("a b c " + " ".join(ITEM.split()[:9]), False),
        ("nothing of the kind", False),
        ("tiny item of five words", True),
        ("tiny item of six words", False),
        ("Is it too short?", True),
        ("too very short", False),
        ("前言" + CHINESE + "后记", True),
        (CHINESE[:6] + "错" + CHINESE[7:], True),
        (CHINESE[:6] + "错错错" + CHINESE[9:], False),
        ("", False),
        (None, False),
    ],
)
def test_substitutions(spark, text, found):
    items = spark.createDataFrame([(1, ITEM), (2, "tiny item of five words"), (3, "too short"), (4, None), (5, CHINESE)], "item_id long, text string")
    docs = spark.createDataFrame([(5, text)], "doc_id long, text string")
    assert bool(decontaminate.contaminated(docs, items).count()) == found
    assert decontaminate.clean(docs, items).count() == (not found)


def test_shortest_items_can_be_left_out(spark):
    items = spark.createDataFrame([(1, "yes"), (2, "a whole item of more words")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "yes, yes"), (2, "here is a whole item of more words")], "doc_id long, text string")
    found = sorted((r["doc_id"], r["item_id"], r["doc_at"]) for r in decontaminate.contaminated(docs, items).collect())
    assert found == [(1, 1, 0), (1, 1, 1), (2, 2, 2)]
    assert [r["doc_id"] for r in decontaminate.contaminated(docs, items, shortest=5).collect()] == [2]


def test_decontamination_cases(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "no id here but some words all the same"), (2, None)], "item_id long, text string")
    rows = decontaminate.contaminated(odd_documents, items).collect()
    assert [(r["doc_id"], r["item_id"]) for r in rows] == [(None, 1)]
    kept = decontaminate.clean(odd_documents, items)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 1  # the other row without an id stays
    assert decontaminate.contaminated(no_documents, items).count() == 0
    assert decontaminate.contaminated(odd_documents, items.limit(0)).count() == 0


def test_clean_rows_keep_their_place_beside_a_leak_of_the_same_id(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    rows = [(i, t, tag) for i in (None, 1) for t, tag in ((ITEM, "leak"), ("clean text", "a"), (None, "b"), ("", "c"), ("clean text", "d"))]
    docs = spark.createDataFrame([*rows, (2, "Before " + ITEM, "leak")], "doc_id long, text string, text_hash string")
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    expected = sorted((r for r in rows if r[2] != "leak"), key=str)
    assert sorted(map(tuple, kept.collect()), key=str) == expected


def slow_figures(text):
    found = WORD.findall(text or "")
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    seen, twice = set(), set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    covered = {i + j for i, w in enumerate(windows) if w in twice for j in range(8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(found), sum(map(len, found)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)
    )


def test_figures_against_brute_force(spark, odd_documents, no_documents, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    docs = docs.unionByName(odd_documents.select("doc_id", "text", "source"))
    more = [(100 + n, " ".join(["same"] * n), "s") for n in range(7, 20)] + [(200, "a b c d e f g h a b c d e f g h a\n\na\n a", "s")]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    rows = host_rules.figures(docs, keep=("doc_id", "text")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert tuple(r[f] for f in host_rules.FIGURES) == slow_figures(r["text"])
    verdicts = host_rules.verdicts(odd_documents).collect()
    assert len(verdicts) == odd_documents.count() and not any(r["kept"] and r["base_failed"] for r in verdicts)
    assert host_rules.verdicts(no_documents).count() == 0


def test_a_small_host_is_not_judged_alone(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(i, good if i % 10 else "short", f"h{i % 20}") for i in range(2000)]
    rows += [(5000 + i, "short", "bad") for i in range(300)] + [(6000, "short", "tiny"), (6001, good, "tiny"), (7000, good, "bad")]
    found = host_rules.verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r["doc_id"]: r["kept"] for r in found.collect()}
    assert kept[6001] and not kept[7000] and not kept[6000] and kept[1]


def slow_targets(sizes):
    ranked = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(ranked)}
    total, out, open_ = sum(sizes.values()), {}, set(sizes)
    while open_:
        level = (total - sum(out.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] <= weight[s] * level}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        out |= {s: 3 * sizes[s] for s in full}
        open_ -= full
    return out


@pytest.mark.parametrize("sizes", [{"a": 900, "b": 10, "c": 5000, None: 40, "é": 7}, {"x": 5}, {"a": 0, "b": 30}, {}])
def test_mix_comes_near_its_targets(spark, sizes):
    rows = [(i, " ".join(["w"] * 5), s) for s, n in sizes.items() for i in range(n // 5)]
    rows += [(10_000 + i, " ".join(["w"] * (n % 5)), s) for i, (s, n) in enumerate(sizes.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed(docs, mixing.plan(docs)).select("source", "doc_id", "mix.*").collect()
    targets = slow_targets(sizes)
    assert len(out) == len(rows)
    for s, n in sizes.items():
        own = [r for r in out if r["source"] == s]
        assert all(r["source_size"] == n and r["target"] == pytest.approx(targets[s]) for r in own)
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - targets[s]) <= len(own) * 0 + mixing.PACKET
    assert sum(r["taken"] for r in out) <= sum(sizes.values())


def test_mixing_cases(odd_documents, no_documents):
    docs = odd_documents
    first, again = (
        sorted(map(str, mixing.mixed(docs, mixing.plan(docs)).select("doc_id", "source", "mix.*").collect())) for _ in range(2)
    )
    assert first == again and len(first) == docs.count()
    assert mixing.mixed(no_documents, mixing.plan(no_documents)).count() == 0


def test_snapshots_collapse(spark):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "bye"), ("assistant", None)]
    logs = [(c, 10 * t, role, text) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1)) for t, (role, text) in enumerate(talk[:n])]
    logs += [(5, 0, "Human", "hi"), (5, 1, "gpt", "<|im_end|> other")]
    logs += [(5, 0, "Human", "hi")]  # a repeated row
    logs += [(None, None, None, None)]
    frame = spark.createDataFrame(logs, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: (r["n_turns"], r["text"]) for r in chat.rendered(frame).collect()}
    assert set(found) == {2, 5, None}
    assert found[2][0] == 4 and found[2][1].count("<|im_start|>") == 4
    assert found[5][1].count("<|im_end|>") == 2 and "< |im_end|>" in found[5][1]
    assert found[None] == (1, "<|im_start|>unknown\n<|im_end|>")
    assert chat.rendered(frame.limit(0)).count() == 0


def test_long_conversations_come_in_parts(spark):
    n = 2 * chat.PART + 10
    logs = [(c, t, "user", str(t)) for c, m in ((1, n), (2, n - 5)) for t in range(m)]
    frame = spark.createDataFrame(logs, "conv_id long, turn long, role string, text string")
    rows = sorted(chat.rendered(frame).collect(), key=lambda r: r["part"])
    assert [(r["conv_id"], r["n_turns"], r["part"]) for r in rows] == [(1, n, 0), (1, n, 1), (1, n, 2)]
    assert sum(r["text"].count("<|im_start|>") for r in rows) == n


def slow_chats(logs):
    """{conversation id: (turns, text)} of those that are no prefix and no copy of another."""
    own = {}
    for conv, turn, role, text in dict.fromkeys(logs):
        own.setdefault(conv, []).append((turn is not None, turn or 0, role, text or ""))
    said = {c: [(role, text) for _, _, role, text in sorted(rows)] for c, rows in own.items()}
    order = sorted(said, key=lambda c: (c is None, c or 0))
    kept = {}
    for i, c in enumerate(order):
        copies = any(said[d] == said[c] for d in order[:i])
        if not copies and not any(len(said[d]) > len(said[c]) and said[d][: len(said[c])] == said[c] for d in order):
            kept[c] = (len(said[c]), "\n".join(f"<|im_start|>{r}\n{t}<|im_end|>" for r, t in said[c]))
    return kept


@pytest.mark.parametrize("part", [2, 1024])
def test_turn_numbers_do_not_matter(spark, monkeypatch, part):
    """Sparse and negative turn numbers, null ids, other columns; sums over small cells."""
    monkeypatch.setattr(chat, "PART", part)
    logs = [(1, 0, "user", "a"), (1, 5000, "assistant", "b"), (2, -7, "user", "a"), (2, 10**15, "assistant", "b"), (2, 10**16, "user", "c")]
    logs += [(3, t * 3_600_000, "user" if t % 2 else "assistant", f"t{t}") for t in range(9)]
    logs += [(4, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(7)]
    logs += [(None, None, "user", "x"), (None, 3, "user", "y"), (None, 3, "user", "y"), (5, 0, "user", "z" * 100_000)]
    frame = spark.createDataFrame([(*r, "p", 1) for r in logs], "conv_id long, turn long, role string, text string, part string, place int")
    found = {r["conv_id"]: (r["n_turns"], r["text"]) for r in chat.rendered(frame, 1024).collect()}
    assert found == slow_chats(logs)
    pieces = chat.rendered(frame, 4).where("conv_id = 3").collect()
    assert sorted((r["part"], r["n_turns"]) for r in pieces) == [(0, 9), (1, 9), (2, 9)]
