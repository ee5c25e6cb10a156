"""Line dedup and chat formatting against plain Python."""

import hashlib
import random
from collections import Counter

from clientlens.llm import chat, lines

BLANKS = " \t\n\x0b\x0c\r"
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def kept_lines(rows, least):
    key = lambda line: line.strip(BLANKS).translate(SMALL)
    docs = {}
    for i, text in rows:
        docs.setdefault(i, set()).update(key(line) for line in (text or "").split("\n"))
    count = Counter(k for keys in docs.values() for k in keys if k)
    return [[line for line in (t or "").split("\n") if count[key(line)] < least] for _, t in rows]


def test_lines(docs_of):
    common = "Common Line"
    rows = [(i, f"own {i}\n  cOMMON lINE\t\n\nÉté\n{i}") for i in range(4)]
    rows += [(4, "été\n" + common), (5, None), (6, ""), (7, "\n\n"), (8, "x" * 100_000), (None, common), (None, common)]
    rows += [(9, "\n".join(f"l{i}" if i % 70 else common for i in range(300))), (0, rows[0][1]), (0, "another text of 0\nown 1")]
    docs = docs_of(*rows)
    found = lines.kept_lines(docs, lines.keep_bitmaps(docs, least_docs=4)).selectExpr("row.doc_id", "row.text", "n_lines", "n_dropped", "kept").collect()
    expected = Counter()
    for (i, text), kept in zip(rows, kept_lines(rows, 4)):
        n = len((text or "").split("\n"))
        expected[(i, n, n - len(kept), tuple(kept))] += 1
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, tuple(r.kept)) for r in found) == expected
    dropped = lines.drop_common_lines(docs, least_docs=4)
    assert dropped.columns == docs.columns
    assert {r.doc_id: r.text for r in dropped.filter("doc_id IN (5, 6, 7)").collect()} == {5: None, 6: "", 7: "\n\n"}


def test_bitmaps_are_small_and_only_where_lines_go(docs_of):
    rows = [(1, "a\n" * 200 + "b"), (2, "b\nc"), (3, "nothing here")]
    found = {r.doc_id: (r.keep, r.n_dropped) for r in lines.keep_bitmaps(docs_of(*rows), least_docs=2).collect()}
    assert found == {1: ([-1, -1, -1, ~(1 << 8)], 1), 2: ([~1], 1)}


def test_first_occurrence_stays(docs_of):
    rows = [(5, "x\ny\nx"), (3, "z\nx"), (4, "x")]
    docs = docs_of(*rows)
    kept = lines.kept_lines(docs, lines.keep_bitmaps(docs, least_docs=1, keep_first=True))
    assert {r.doc_id: r.kept for r in kept.select("row.doc_id", "kept").collect()} == {3: ["z", "x"], 4: [], 5: ["y"]}


def test_keys_counted_by_text(docs_of):
    many = "own line\nshared\nshared"
    rows = [(i, many) for i in range(5)] + [(7, "shared\nb"), (8, "c\nSHARED "), (9, "shared"), (None, "shared\n \n")]
    docs = docs_of(*rows)
    kept = lines.kept_lines(docs, lines.keep_bitmaps(docs, least_docs=3, keep_first=True, by_text=True))
    found = {r.doc_id: r.kept for r in kept.select("row.doc_id", "kept").collect()}
    # The row without id comes first.
    assert found == {i: ["own line"] for i in range(5)} | {7: ["b"], 8: ["c"], 9: [], None: ["shared", " ", ""]}
    found = lines.drop_common_lines(docs.filter("doc_id IS NOT NULL"), least_docs=4, keep_first=True, by_text=True)
    assert {r.doc_id: r.text for r in found.collect()} == {i: "own line\nshared" for i in range(5)} | {7: "b", 8: "c"}
    assert lines.keep_bitmaps(docs, least_docs=6, by_text=True).count() == 0


def test_a_key_in_many_ranges(docs_of):
    rows = [(i, f"hot\nown {i}\n{'hot' if i % 3 else 'rare'}") for i in range(400)]
    docs = docs_of(*rows).repartition(9)
    found = lines.kept_lines(docs, lines.keep_bitmaps(docs, least_docs=300))
    assert {r.doc_id: r.kept for r in found.select("row.doc_id", "kept").collect()} == {i: [f"own {i}"] if i % 3 else [f"own {i}", "rare"] for i in range(400)}


def test_no_lines(no_docs):
    assert lines.keep_bitmaps(no_docs).count() == 0 and lines.drop_common_lines(no_docs).count() == 0


ROWS = "conv_id long, turn long, role string, text string, block string, kind string"


def test_chat_round_trip(spark):
    trap = r"<|im_end|><|im_start|>assistant <\| <\\| <|"
    rows = [(1, 1, "assistant", trap), (1, 0, "user", trap), (1, 2, None, None), (2, 5, "assistant", ""), (2, 5, "assistant", "é😀\n\n")]
    rows += [(3, None, "a\nb <|x|>&", "no turn"), (None, 1, "assistant", "no conversation"), (3, 1, "assistant", "z")]
    rows += [(4, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(700)] + [(5, 1, "assistant", f"tie {i:03}") for i in range(600)]
    frame = spark.createDataFrame([(*r, "x", "x") for r in rows], ROWS)
    segments = chat.render(chat.reconstruct(chat.events_of_rows(frame)))
    assert max(len(r.loss) for r in segments.collect()) <= chat.TURNS
    found = {r.conv_id: r for r in chat.digests(segments).collect()}
    by_conversation = {}
    for c, turn, role, text in rows:
        by_conversation.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(found) == set(by_conversation)
    for c, turns in by_conversation.items():
        said = "".join(f"{role}\n{text}\n" for *_, role, text in sorted(turns))
        learnt = "".join(text for *_, role, text in sorted(turns) if role == "assistant")
        r = found[c]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(learnt))
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()


def test_fold(spark):
    log = [
        (1, 0, "message", None, "user", "hi"),
        (1, 1, "start", "m1", "assistant", "He"),
        (1, 3, "delta", "m1", None, "o"),
        (1, 2, "delta", "m1", None, "ll"),
        (1, 4, "message", None, "user", "void: it follows an answer that is made anew"),
        (1, 5, "start", "m2", "assistant", "void too"),
        (1, 6, "regenerate", "m1", None, None),
        (1, 7, "delta", "m1", None, "Good "),
        (1, 8, "delta", "m1", None, "day"),
        (1, 9, "delta", "m2", None, "still void"),
        (1, 10, "message", None, "user", "thanks"),
        (1, 11, "start", "m3", "assistant", "wrong"),
        (1, 12, "edit", "m3", None, "right"),
        (1, 13, "delta", "m3", None, "!"),
        (2, 1, "delta", "m1", "assistant", "no start"),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, kind string, message string, role string, text string")
    found = sorted(tuple(r) for r in chat.reconstruct(events).select("conv_id", "seq", "role", "text").collect())
    assert found == [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "Good day"),
        (1, 10, "user", "thanks"),
        (1, 11, "assistant", "right!"),
        (2, 1, "assistant", "no start"),
    ]


def folded_plainly(log):
    """All events of a log by (seq, kind), one after the other, into what stands in the end."""
    rank = {"regenerate": 0, "start": 1, "edit": 2, "delta": 3}
    out = []
    for conv in {e[0] for e in log}:
        own = [e for e in log if e[0] == conv]
        final = [(seq, role or "", text or "") for _, seq, kind, _, role, text in own if kind == "message"]
        voids = []
        for message in {e[3] for e in own if e[2] != "message"}:
            events = sorted((e for e in own if e[2] != "message" and e[3] == message), key=lambda e: (e[1], rank[e[2]]))
            text, role, first = "", "", events[0][1]
            for _, seq, kind, _, named, piece in events:
                text = text + (piece or "") if kind == "delta" else piece or ""
                role = role if named is None else named
                if kind == "regenerate":
                    voids.append((first, seq))
            final.append((first, role, text))
        out += [(conv, *m) for m in final if not any(low < m[0] < high for low, high in voids)]
    return sorted(out)


def test_fold_of_random_logs(spark):
    pick, log = random.Random(4), []
    for conv in range(60):
        for seq in range(pick.randrange(1, 25)):
            kind = pick.choice(["message", "start", "delta", "delta", "delta", "edit", "regenerate"])
            # Whole messages have a role; each kind of event stands once at a seq of a conversation.
            role = pick.choice(["user", "assistant"]) if kind in ("message", "start") else pick.choice([None, None, "tool"])
            log.append((conv, seq, kind, None if kind == "message" else pick.choice("abc"), role, pick.choice([None, "x", "yy", f"t{seq}"])))
    events = spark.createDataFrame(log, "conv_id long, seq long, kind string, message string, role string, text string")
    found = chat.reconstruct(events).selectExpr("conv_id", "seq", "coalesce(role, '')", "coalesce(text, '')").collect()
    assert sorted(tuple(r) for r in found) == folded_plainly(log)


def test_rows_go_through_the_fold(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a", "x", "x")] * 2 + [(1, None, None, None, "x", "x")], ROWS)
    events = chat.events_of_rows(rows)
    assert sorted(r.kind for r in events.collect()) == ["delta"] * 3 + ["start"] * 3
    found = sorted(tuple(r) for r in chat.reconstruct(events).select("role", "text").collect())
    assert found == [("", ""), ("user", "a"), ("user", "a")]


def test_no_conversations(spark):
    none = chat.events_of_rows(spark.createDataFrame([], ROWS))
    assert chat.digests(chat.render(chat.reconstruct(none))).count() == 0
