import re

import pytest

from hearthline.llm import licenses, queries

SF = "/root/testdata/sf0.01"


def spell(template):
    """The template as a regular expression over single-spaced words."""
    parts, token = [], re.compile(r"\[\[|\]\]|\{\{[^|}]*\|\d+\}\}|[^\s\[\]{}]+")
    for t in token.findall(template):
        if t == "[[":
            parts.append("(?:")
        elif t == "]]":
            parts.append(")?")
        elif t.startswith("{{"):
            parts.append(r"(?: \S+){0,%s}" % t[:-2].rpartition("|")[2])
        else:
            parts += [" " + re.escape(w.decode()) for w in licenses.words(t.encode())]
    return re.compile("".join(parts) + "(?= )")


@pytest.mark.parametrize("label,template", licenses.TEMPLATES)
def test_every_template_against_its_expression(label, template):
    automaton, plain = licenses.compile_template(template), spell(template)
    bare = re.sub(r"\[\[.*?\]\]", "", template.replace("[[{{style|2}}]]", "").replace("[[{{scope|1}} license]]", "")
                  .replace("[[{{kind|1}}]]", "").replace("[[this {{work|3}} is]]", ""))
    short = re.sub(r"\{\{.*?\}\}", "", bare)
    filled = re.sub(r"\{\{.*?\}\}", " filler ", template).replace("[[", " ").replace("]]", " ")
    for text in (short, filled, "some words before " + filled + " and after", short.replace(" ", " wrong ", 2), ""):
        own = licenses.words(text.encode())
        joined = b" " + b" ".join(own) + b" "
        assert bool(licenses.matches(own, joined, automaton)) == bool(plain.search(joined.decode())), text


def test_regions():
    automaton = licenses.compile_template("made [[or {{how|2}}]] under license {{id|2}} only")
    for text, accepted in (("made under license only", 4), ("made or built by under license x y only", 9),
                           ("made or under license z only", 6), ("made or a b c under license only", None),
                           ("made under license a b c only", None), ("made under the license only", None)):
        own = text.encode().split()
        spans = licenses.matches(own, b" " + b" ".join(own) + b" ", automaton)
        assert [b - a + 1 for a, b in spans] == ([accepted] if accepted else [])


def test_bad_templates():
    with pytest.raises(ValueError):
        licenses.compile_template("[[all optional]]")
    with pytest.raises(ValueError):
        licenses.compile_template("one [[two")


def test_awkward_rows(spark, texts_frame):
    docs = texts_frame([(1, None), (2, ""), (3, "CC-BY cc by, Cc\nBy!"), (None, "All rights reserved."),
                        (4, "x " * 50_000 + "released under the MIT license"), (5, "cc byé by cc all rights")])
    out = {r.doc_id: r for r in licenses.scan(docs, ["doc_id"]).collect()}
    assert (out[1].n_words, out[1].n_base, out[1].first_word, out[1].labels, out[1].score) == (0, 0, None, "", 0.0)
    assert (out[3].n_base, out[3].first_word, out[3].last_word, out[3].base_labels) == (3, 0, 4, "cc-by")
    assert (out[None].labels, out[None].score) == ("reserved", 1.0)
    assert (out[4].labels, out[4].base_labels, out[4].n_words) == ("mit", "", 50_005)
    assert out[5].n_base == 0 and out[2].n_words == 0
    assert licenses.scan(docs.limit(0), ["doc_id"]).count() == 0


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    plain = [(label, spell(t)) for label, t in licenses.TEMPLATES]
    rows = {r.doc_id: r for r in queries.QUERIES["op6_licenses"](spark, SF).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in d.text or "")
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        starts, labels = [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            at = [i for i in range(len(own)) if own[i:i + len(p)] == p]
            starts += at
            labels |= {label} if at else set()
        r = rows[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(own), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        joined = " " + " ".join(own) + " "
        assert r.labels == ",".join(sorted(labels | {label for label, e in plain if e.search(joined)}))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
