import random

from hypothesis import given, settings
from hypothesis import strategies as st

from hearthline.llm import queries, spans

SF = "/root/testdata/sf0.001"


def plain(docs, run=spans.RUN, least=spans.LEAST_WORDS):
    """Texts after removal, by a dictionary over all runs in order of id and place."""
    seen, result = set(), []
    for _, text in docs:
        parts = spans.sentences(text or "")
        gone = set()
        for i in range(len(parts) - run + 1):
            key = tuple(tuple(p.encode().lower().split()) for p in parts[i:i + run])
            if sum(map(len, key)) < least:
                continue
            if key in seen:
                gone |= set(range(i, i + run))
            seen.add(key)
        result.append(None if text is None else "".join(p for i, p in enumerate(parts) if i not in gone))
    return result


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.!? \n。é", max_size=120))
def test_pieces_are_the_text(text):
    parts = spans.sentences(text)
    assert "".join(parts) == text
    assert all(len(p.split()) <= spans.LONG for p in parts)


def _sentences(rng, n):
    return [" ".join(rng.choices("alpha beta gamma delta rho tau phi chi psi omega".split(), k=rng.randint(3, 40)))
            .capitalize() + "." for _ in range(n)]


def test_repeats_against_brute_force(spark, texts_frame):
    rng = random.Random(6)
    passage = _sentences(rng, 5)
    rows = []
    for i in range(30):
        own = _sentences(rng, rng.randint(1, 12))
        at = rng.randint(0, len(own))
        rows.append((i, " ".join(own[:at] + (passage if i % 3 else []) + own[at:])))
    rows += [(50, None), (51, ""), (52, rows[4][1]), (53, " \n ")]
    out = {r.doc_id: r for r in spans.remove_repeats(texts_frame(rows)).collect()}
    assert [out[i].text for i, _ in rows] == plain(rows)
    text = " ".join(passage)
    assert sum(text in (out[i].text or "") for i, _ in rows) == 1
    assert out[52].text == "" and out[50].text is None
    assert out[2].removed_sentences > 0 and out[0].removed_sentences == 0


def test_awkward_rows(spark, texts_frame):
    long = " ".join(f"This is sentence number {i} of a very long text." for i in range(20_000))
    rows = [(1, long), (None, long), (None, "One short text."), (2, "Tell it. " * 3), (2, "Tell it. " * 3)]
    docs = texts_frame(rows)
    out = spans.remove_repeats(docs)
    assert out.columns == [*docs.columns, "removed_sentences"]
    got = sorted(((r.doc_id, len(r.text), r.removed_sentences) for r in out.collect()), key=str)
    assert got == [(1, len(long), 0), (2, 27, 0), (2, 27, 0), (None, 0, 20_000), (None, 15, 0)]
    assert spans.remove_repeats(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rows = {r.doc_id: r.text for r in queries.QUERIES["op3_sentence_spans"](spark, SF).collect()}
    assert [rows[d.doc_id] for d in docs] == plain(docs)


def _some_words(rng, n):
    return [f"w{rng.randrange(3_000)}" for _ in range(n)]


def _around(rng, passage):
    """A text that holds the sentences of the passage; it begins and ends inside a sentence."""
    first, *rest = [" ".join(p) for p in passage]
    parts = [" ".join(_some_words(rng, rng.randint(1, 40))) + " " + first, *rest]
    return (" ".join(_some_words(rng, 12)) + ". " + ". ".join(parts) + " "
            + " ".join(_some_words(rng, rng.randint(1, 40))) + ". " + " ".join(_some_words(rng, 12)) + ".")


def test_passages_inside_sentences_are_found(spark, texts_frame):
    """Passages of 55 words and more, beginning and ending at any place of a sentence."""
    rng = random.Random(10)
    rows = []
    for shape in ([55], [60], [27, 28], [30, 25], [100]) * 20:
        passage = [_some_words(rng, n) for n in shape]
        rows += [(len(rows), _around(rng, passage)), (len(rows) + 1, _around(rng, passage))]
    out = {r.doc_id: r.removed_sentences for r in spans.remove_repeats(texts_frame(rows)).collect()}
    assert all(out[i] == 0 for i in range(0, len(rows), 2))
    assert all(out[i] >= 3 for i in range(1, len(rows), 2))


def test_cuts_do_not_depend_on_what_stands_before():
    rng = random.Random(11)
    for words in (_some_words(rng, 200), ["word"] * 200, ["to", "and", "fro"] * 60, _some_words(rng, 17)):
        sizes = [len(p.split()) for p in spans.sentences(" ".join(words))]
        assert spans.PIECE - 1 <= min(sizes) and max(sizes) <= spans.PIECE_MOST
    long = _some_words(rng, 200)
    whole, later = spans.sentences(" ".join(long)), spans.sentences(" ".join(_some_words(rng, 7) + long))
    assert whole[5:] == later[len(later) - len(whole) + 5:]
