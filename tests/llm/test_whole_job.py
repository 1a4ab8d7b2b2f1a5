"""The operators do the whole job: results don't depend on the corpus's size or on bounds of the operators' own."""

from __future__ import annotations

import random
import re
import time
from itertools import permutations
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import common, leakage, lookalikes, markup, name_variants, pii, repetition, site_lines, truncation
from pagewright.llm.queries import QUERIES

from .conftest import audit_row

WORDS = [f"{a}{b}{c}" for a in ("bel", "cor", "dan", "fus", "gri", "hol", "jam", "kep", "lur", "mon") for b in ("ta", "re", "mi", "so", "du") for c in ("n", "rk", "st", "l", "ph", "g")]


def test_listed_words_count_at_any_size(spark, written_tables, monkeypatch):
    often, seldom = ["Ann Olga Smith"] * 230_000, ["Bo Quennell"] * 3
    folder = written_tables(audit_trail=[audit_row("s_page_01", "She saw Quennell.", entities=often + seldom)])
    assert {"ann", "quennell"} <= pii.vocabulary(spark, folder).persons.keys()
    assert {"ann", "quennell"} <= common.entity_words(spark, folder)
    monkeypatch.setattr(common, "BROADCAST_NAMES", 1)
    assert common.entity_words(spark, folder, ["quennell", "other"]) == {"quennell"}


def test_listed_words_joined(spark, data, monkeypatch):
    def rows():
        return {name: sorted(map(repr, QUERIES[name](spark, data).collect())) for name in ("p2_found", "p2_scrubbed")}

    broadcast = rows()
    monkeypatch.setattr(common, "BROADCAST_NAMES", 0)
    assert pii.vocabulary(spark, data).rest.count() > 0
    assert rows() == broadcast


def test_raw_texts_are_repaired_and_cleaned(spark, written_tables):
    audit = [audit_row("s_page_03", "The wound was clean. " * 20)]
    corpus = [("s_page_03", "3\nThe wo-\nund was <b>clean</b>.", None, None)] * 2
    corpus += [("s_page_03", "The wound was <i>clean</i>.\n3", None, None), ("t_page_01", "<b>Only</b> raw", None, None), ("t_page_02", None, None, None), (None, "no key", None, None)]
    folder = written_tables(audit_trail=audit, corpus_dict=corpus)

    def rows(name):
        return sorted(((r.page_key, r.text and " ".join(r.text.split())) for r in QUERIES[name](spark, folder).collect()), key=str)

    assert rows("p5_repaired_raw") == [("s_page_03", "The wound was <b>clean</b>."), ("s_page_03", "The wound was <i>clean</i>."), ("t_page_01", "<b>Only</b> raw"), ("t_page_02", None)]
    assert rows("p7_clean_raw") == [("s_page_03", "3 The wo- und was clean."), ("s_page_03", "The wound was clean. 3"), ("t_page_01", "Only raw"), ("t_page_02", None)]


def test_length_limits_stand_out_in_a_stem_of_any_size(spark):
    def pages(stem, lengths):
        return [(f"{stem}_page_{k:04}", "a" * n) for k, n in enumerate(lengths)]

    big = [n for n in range(200, 300) for _ in range(5)] + [250] * 60
    rows = spark.createDataFrame(pages("big", big) + pages("small", [700, 700, 700, 720]), "page_key string, clean_ocr string")
    found = truncation.truncation(rows, common.Lexicon({})).where("at_limit").select("stem", "n_chars").distinct().collect()
    assert {(r.stem, r.n_chars) for r in found} == {("big", 250), ("small", 700)}


# ---- 6


def _entities(rows) -> set[frozenset]:
    groups: dict = {}
    for r in rows:
        groups.setdefault((r.stem, r.entity), set()).add(r.name)
    return {frozenset(v) for v in groups.values()}


@pytest.mark.parametrize("contracted", [True, False])
def test_a_chain_of_names_is_one_entity(spark, written_tables, monkeypatch, contracted):
    if not contracted:  # labels alone must find it as well
        monkeypatch.setattr(name_variants, "contracted", lambda batches: batches)
    names = ["quabzefnor"]
    for k in range(40):  # each name one letter away from the one before, in another place
        at = 1 + k % 9
        names.append(names[-1][:at] + chr(ord("a") + (ord(names[-1][at]) - 97 + 7) % 26) + names[-1][at + 1 :])
    assert len(set(names)) == 41
    folder = written_tables(patient_data_extractor=[(1, "s", "s_page_01", 0, "t", True, [f"Ann {n.title()}" for n in names], None)])
    assert [len(g) for g in _entities(QUERIES["p6_variants"](spark, folder).collect())] == [41]


def test_hot_keys_are_joined_in_parts(spark, data, monkeypatch):
    whole = sorted(map(tuple, QUERIES["p6_found"](spark, data).collect()))
    monkeypatch.setattr(name_variants, "KEY_PART", 1)
    assert sorted(map(tuple, QUERIES["p6_found"](spark, data).collect())) == whole


@given(st.lists(st.sampled_from(["ann", "a", "b", "bob", "robert", "anne", "c"]), max_size=4), st.lists(st.sampled_from(["ann", "a", "r", "bob", "rob", "anna", "c"]), max_size=5))
@settings(max_examples=300, deadline=None)
def test_alignment_by_brute_force(a, b):
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = float("inf")
    for order in permutations(range(len(long)), len(short)):
        left = [long[k] for k in range(len(long)) if k not in order]
        if short and any(len(x) > 1 for x in left) and all(len(x) == 1 for x in short) and order[0] != 0:
            continue
        best = min(best, sum(name_variants.given_cost(x, long[k]) + 0.1 * (i != k) for i, (x, k) in enumerate(zip(short, order))))
    assert name_variants.align(a, b) == pytest.approx(best if short else 2.0 if not long else 3.0)


def test_names_of_any_length(spark, written_tables):
    """Names of many words and of long words are linked like others."""
    long = "Llanfairpwll" * 8
    groups = [
        ["Maria Isabel Teresa Carmen Holmen", "HOLMEN, Maria Isabel Teresa Carmen", "Maria Isabel Terresa Carmen Holmen"],
        [f"Ann {long}", f"ann {long[:40]}x{long[40:]}", f"Anne {long[:60]}{long[61:]}"],
        [f"{long} Quennell", f"{long[:50]}{long[51:]} Quennel"],
        ["Old Tressa Gwenfa Brannoc Decla Fyncha Zennor Maddern Alkeld General Hospital", "old Tressa Gwenfa Branoc Decla Fyncha Zennor Maddern Alkeld Gen. Hosp."],
    ]
    rows = [(k, "s", None, 0, "t", True, x, None) for k, x in enumerate(groups)]
    found = _entities(QUERIES["p6_variants"](spark, written_tables(patient_data_extractor=rows)).collect())
    assert sorted(map(sorted, found)) == sorted(map(sorted, groups))


@given(st.text(alphabet="abcdef", min_size=59, max_size=70), st.lists(st.tuples(st.integers(1, 57), st.sampled_from("+-=%")), max_size=2))
@settings(max_examples=200, deadline=None)
def test_the_index_of_long_names_is_complete(a, edits):
    b = a
    for at, edit in edits:
        b = {"+": b[:at] + "f" + b[at:], "-": b[:at] + b[at + 1 :], "=": b[:at] + "f" + b[at + 1 :], "%": b[:at] + b[at : at + 2][::-1] + b[at + 2 :]}[edit]
    if name_variants.near(a, b):
        assert name_variants.keys_of(a) & name_variants.keys_of(b)


def test_long_lists_of_given_names_are_aligned():
    names = [f"{a}{b}n" for a in "bcdfghjklm" for b in "aeiou"]
    assert name_variants.align(names, [names[1], names[0], *names[2:]]) == pytest.approx(0.2)
    assert name_variants.one_person(names, names) and not name_variants.one_person(names, names[::-1])


def test_a_person_of_many_stems_is_no_stock_phrase(spark, written_tables):
    lists = [(k, f"s{k}", f"s{k}_page_01", 0, "t", True, ["Ann Holmen", "Ann Holmmen", "Left Knee", "left knee"], None) for k in range(20)]
    folder = written_tables(patient_data_extractor=[*lists, (99, "s0", "s0_page_01", 0, "t", True, ["Dr A Holmen"], None)])
    names = {r.name for r in QUERIES["p6_variants"](spark, folder).collect()}
    assert names == {"Ann Holmen", "Ann Holmmen", "Dr A Holmen"}


def test_tables_of_a_query_are_deleted(spark):
    rows = common.written(spark.range(3), "t")
    assert len(rows.inputFiles()) > 0
    common.dropped(rows)
    assert not any(Path(f.removeprefix("file://")).exists() for f in rows.inputFiles())


# ---- 9


def _leak_tables(written_tables):
    rng = random.Random(4)
    pool = [f"w{k}{chr(97 + k % 26)}" for k in range(400)]
    items = {n: [f"q{n}x{k}" for k in range(n)] for n in range(1, 7)}  # short items, each of its own words
    items |= {10 + k: rng.choices(pool[:40], k=rng.choice([8, 14, 40, 90])) for k in range(12)}  # of words that repeat
    docs, filler = {}, lambda: rng.choices(pool[:40], k=rng.randrange(3, 30))
    for k in range(160):
        item = rng.choice(list(items.values()))
        part = item[: rng.choice([len(item), len(item), (len(item) + 1) // 2, max(1, len(item) // 4)])]
        docs[k] = filler() + part + filler() + (part if k % 5 == 0 else []) + filler()
    documents = [(k, " ".join(w), None, None, None, None, None, None) for k, w in docs.items()]
    return written_tables(documents=documents, eval_items=[(k, "s", " ".join(w), "") for k, w in items.items()]), docs, items


def test_leaks_joined_and_broadcast_are_equal(spark, written_tables, monkeypatch):
    folder, docs, items = _leak_tables(written_tables)
    broadcast = sorted(map(tuple, QUERIES["p9_leaks"](spark, folder).collect()))
    assert len({r[1] for r in broadcast}) > 12
    monkeypatch.setattr(leakage, "BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, QUERIES["p9_leaks"](spark, folder).collect())) == broadcast


def test_whole_short_items_are_found_and_every_passage_goes(spark, written_tables):
    folder, docs, items = _leak_tables(written_tables)
    found = {(r.doc_id, r.item_id) for r in QUERIES["p9_found"](spark, folder).collect()}
    texts = {r.doc_id: f" {r.text} " for r in QUERIES["p9_clean"](spark, folder).collect()}
    for k, words in docs.items():
        for n in range(1, 7):
            whole = f" {' '.join(items[n])} "
            if whole in f" {' '.join(words)} ":
                assert (k, n) in found and whole not in texts[k]
    assert len(texts) == len(docs)


def test_every_passage_of_an_item_is_found():
    item = [f"i{k}" for k in range(12)]
    words = ["x"] * 3 + item + ["y"] * 2 + item[:8] + ["z"] * 60 + item
    assert sorted(leakage.Index([(1, item)]).leaks(words)) == [(1, 8, 17, 24), (1, 12, 3, 14), (1, 12, 85, 96)]
    assert leakage._united([(5, 9), (1, 3), (8, 12), (20, 21)]) == [(1, 3), (5, 12), (20, 21)]


# ---- 7

CONSTRUCTS = (
    "<!-- x -->", "<b>", "</b>", "&amp;", "&#160;", "```x```", "~~~x~~~", "``x``", "`x`", "![a](b)", "[a](b)", "**a**", "__a__", "~~a~~", "*aa*", "_very ill_", "| :-- |", "# A", "> A", "- [ ] a", "+ [x] a",
    "{| a |}", "{{a}}", "[[a]]", "== A ==", "====", "'''a'''", "''a''", "\\\\begin{a}", "\\\\section{A}", "\\\\item x", "$a^2$", "\\\\(a\\\\)", "\\\\[a\\\\]",
)


@pytest.mark.parametrize("construct", CONSTRUCTS)
def test_the_test_for_markup_lets_every_construct_through(construct):
    construct = construct.replace("\\\\", "\\")
    for text in (construct, f"word\n{construct}\nword", f"word {construct} word", f"word: {construct} word", f"a<b{construct}"):
        nodes = [(n.start, n.end) for n in markup.parse(text).all() if n.kind != "sign"]
        whole = [m.span() for m in markup.TOKENS.finditer(text)]  # the constructs without any test
        assert set(nodes) <= set(whole) | {n for n in nodes if any(a < n[0] for a, _ in whole)} and bool(nodes) == bool(whole), text
        assert not whole or markup.SUSPECTED.search(text), text
    assert markup.TOKENS.match(construct)
    assert re.compile(markup.SUSPECT).match(construct)  # parsing starts at these places only


def test_deep_and_long_markup():
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert markup.clean_text(deep, markup.DEFAULT).strip() == "x"
    assert markup.clean_text("<b>" * 50_000 + "x <i>y</i>", markup.DEFAULT) == "x y"
    assert markup.clean_text("<p>one <b>two</b>", markup.DEFAULT) == "one two"
    assert markup.clean_text("<ul><li>one<li>two</ul>", markup.DEFAULT) == "- one\n- two"


def test_what_is_learned_decides(spark, written_tables):
    """Pages say which constructs cleaning took: here links and [remarks] go, and *emphasis* stays."""
    raw = "See [the form](x) at *home* and [film] now"
    audit = [audit_row(f"s_page_{k:02d}", "See the form at *home* and now") for k in range(60)]
    folder = written_tables(audit_trail=audit, corpus_dict=[(f"s_page_{k:02d}", raw, None, None) for k in range(60)])
    found = {(r.field, r.markup) for r in QUERIES["p7_found"](spark, folder).collect()}
    assert found == {("raw_text", "markdown"), ("raw_text", "wiki")}
    assert markup.kinds_of("at *home* now", markup.DEFAULT) == ["markdown"]  # what an untrained model says
    trained = markup.fit([(raw, "See the form at *home* and now")] * 60)
    assert markup.kinds_of("at *home* now", trained) == [] and markup.kinds_of("and [film] now", trained) == ["wiki"]


# ---- 3


def test_the_posterior_decides_which_pages_are_measured(spark, data, monkeypatch):
    """No rule knows the exact share; without the posterior there are other rows."""
    exact = {r.page_key for r in QUERIES["p3_quality"](spark, data).where("repeated_share >= 0.3").collect()}
    assert {r.page_key for r in QUERIES["p3_found"](spark, data).collect()} == exact != set()
    posterior = repetition.posterior
    monkeypatch.setattr(repetition, "posterior", lambda model, votes: 1 - posterior(model, votes))
    assert {r.page_key for r in QUERIES["p3_found"](spark, data).collect()} != exact


def test_one_long_passage_is_suspected(spark, data):
    rng = random.Random(1)
    pages = {r.page_key: r for r in QUERIES["p3_quality"](spark, data).collect()}
    patterns: dict = {}
    for r in pages.values():
        votes = tuple(r[f"vote_{x}"] for x in repetition.RULES)
        patterns[votes] = patterns.get(votes, 0) + 1
    model = repetition.fit_rules(list(patterns.items()))
    pool = [f"{x}{y}" for x in "bcdfghjklmnpqrst" for y in ("alo", "ere", "umi", "osa", "ipe", "onu")]
    for n, k in ((75, 26), (100, 34), (300, 110), (1000, 330)):
        words = rng.choices(pool, k=n - k)
        text = " ".join(words) + ". " + ", ".join(words[5 : 5 + k])
        assert repetition.share_of(text) >= 0.3 and repetition.posterior(model, repetition.votes_of(text)[1:]) >= repetition.CANDIDATE


# ---- 4


def test_merged_summaries_keep_heavy_hitters(spark):
    """Summaries of many tasks, merged in several steps, stay small and lose no frequent line, also with a small capacity."""
    rng = random.Random(2)
    rows = [("hot" if k % 3 else f"s{k % 50}", f"line number {rng.random()} of a page that nobody prints\n{'the printed line of the bureau here' if k % 4 == 0 else ''}") for k in range(9000)]
    pages = spark.createDataFrame(rows, "stem string, text string").repartition(70)
    forms = lambda text: {line for line in text.split("\n")}
    for capacity, fan in ((2048, 32), (20, 4)):
        parts = site_lines.merged_summaries(site_lines.summaries(pages, forms, capacity, 0), capacity, 0, fan).toPandas()
        assert parts[parts.wording.isna()].stem.is_unique and parts.groupby("stem").size().max() <= capacity + 1
        heads = parts[parts.wording.isna()].set_index("stem")
        assert heads.n.sum() == 9000 and heads.loc["hot"].n == 6000
        got = parts[(parts.stem == "hot") & (parts.wording == "the printed line of the bureau here")].n.iloc[0]
        assert 1500 - heads.loc["hot"].error <= got <= 1500 and heads.loc["hot"].error <= heads.loc["hot"].lines / capacity + 1


def test_merged_wordings_grow_linearly():
    forms = [" ".join(rng.choices(WORDS, k=9)) for rng in [random.Random(7)] for _ in range(4000)]
    began = time.monotonic()
    assert len(site_lines.merged([(f, 1) for f in forms])) > 3900
    assert time.monotonic() - began < 20


def test_a_line_that_one_summary_holds_once_is_counted(spark, written_tables):
    pages = [audit_row(f"s_page_{k:02d}", f"Please return sheet {k} to the records library\nother {k}") for k in range(6)]
    assert {(r.page_key, r.line_no) for r in QUERIES["p4_found"](spark, written_tables(audit_trail=pages)).collect()} == {(f"s_page_{k:02d}", 1) for k in range(6)}


# ---- 10


def test_accents_on_foreign_letters_and_raised_signs(spark, written_tables):
    text = "La exploración de próstata según la enfermería era normal, y Behçet no se confirmó durante la noche del lunes pasado."
    disguised = text.replace("ó", "о́").replace("é", "é").replace("í", "і́").replace("ç", "с̧")
    assert disguised != text
    area = "The wound of 4 m² was dressed twice a day and ½ of the dose was given, as the ward sister noted in the book at noon."
    texts = [text, disguised, area, area.replace("²", "2"), area.replace("m²", "ｍ²")]
    folder = written_tables(documents=[(k, t, None, None, None, None, None, None) for k, t in enumerate(texts)])
    assert {(r.doc_id_a, r.doc_id_b) for r in QUERIES["p10_found"](spark, folder).collect()} == {(0, 1), (2, 4)}
    assert lookalikes.folded("m² ½ ① ﬁ Ａ　…") == "m² ½ ① fi A ..."


def test_disguised_words_do_not_vouch_for_each_other(spark, written_tables):
    text = "The patient may say so when the registrar asks about the plan, and the ward round went on without any further change."
    foreign = [text.replace(w, d) for w, d in (("say", "ѕау"), ("say", "ѕаy"))]  # wholly and partly of another script
    folder = written_tables(documents=[(k, t, None, None, None, None, None, None) for k, t in enumerate([text, *foreign])])
    assert {(r.doc_id_a, r.doc_id_b) for r in QUERIES["p10_found"](spark, folder).collect()} == {(0, 1), (0, 2), (1, 2)}


def test_short_texts_vouch_for_words(spark, written_tables):
    text = "Тhе хаnthelasma was not seen again, and the ward round went on as planned without any change of the doses at noon."
    folder = written_tables(documents=[(k, t, None, None, None, None, None, None) for k, t in enumerate([text, text.replace("х", "x"), "xanthelasma", "The"])])
    assert {(r.doc_id_a, r.doc_id_b) for r in QUERIES["p10_found"](spark, folder).collect()} == {(0, 1)}


# ---- 5


def test_running_headers_of_any_length(spark, written_tables):
    """Short headers go, lines that stand on few pages or inside a page stay, and numbers of pages are exact."""
    rng = random.Random(8)
    rows = []
    for k in range(1, 21):
        body = [" ".join(rng.choices(WORDS, k=8)).capitalize() + "." for _ in range(16)]
        if k <= 3:
            body[0] = "See the note of the second ward"  # on three of twenty pages
        body[8] = "Ward Seven Notes"  # inside the page it is text
        head = "Ward 5even Notes" if k == 4 else "Ward Sevon Notes" if k == 5 else "WARD SEVEN NOTES"
        rows.append(audit_row(f"s_page_{k:02d}", "\n".join([head, *body, f"- {k} -" if k % 2 else f"{'-' * 60} {k} {'-' * 60}"])))
    texts = {r.page_key: r.text for r in QUERIES["p5_repaired"](spark, written_tables(audit_trail=rows)).collect()}
    for key, text in texts.items():
        assert text.lower().count("seven notes") == 1 and "sevon" not in text.lower() and "--" not in text, text
        assert ("second ward" in text) == (key <= "s_page_03")


def test_vocabulary_joined_and_broadcast_are_equal(spark, data, monkeypatch):
    """What p1 and p5 know doesn't depend on whether the vocabulary can be broadcast."""
    names = ("p1_truncation", "p5_found", "p5_repaired", "p5_repaired_raw")

    def rows():
        return {name: sorted(map(repr, QUERIES[name](spark, data).collect())) for name in names}

    broadcast = rows()
    assert all(broadcast.values()) and any("misread" in r for r in broadcast["p5_found"])
    for most in (50, 0):  # some frequent surfaces are broadcast, or none
        monkeypatch.setattr(common, "MAX_FREQUENT", most)
        joined = rows()
        for name in names:
            assert joined[name] == broadcast[name], name


def test_misread_words_by_brute_force():
    words = {"".join(random.Random(k).choices("abcdeimnorstu", k=3 + k % 9)): 10 * (k + 1) for k in range(60)}
    fix = common.Repairer(words)
    rng = random.Random(3)
    for word in [*words, *("".join(rng.choices("0158cnrilvtf", k=rng.randrange(1, 9))) for _ in range(200))]:
        near, want = {word}, ""
        for _ in range(2 if len(word) > 3 else 1):
            near = {w[:i] + right + w[i + len(wrong) :] for w in near for wrong, right in common.MISREADINGS for i in range(len(w)) if w.startswith(wrong, i)} - {word}
            fits = [w for w in near if len(w) > 2 and words.get(w, 0) >= 8 * max(1, words.get(word, 0))]
            if fits:
                want = max(fits, key=lambda w: (words[w], w))
                break
        assert fix(word) == want
    assert fix("il" * 50_000) == ""


# ---- 1


def test_trie_and_length_decide(spark, written_tables, monkeypatch):
    """A page that ends in a signature is whole, unless its last token is cut and its length is one at which pages pile up."""
    rng = random.Random(6)
    rows, want = [], set()
    for k in range(400):
        text = " ".join(" ".join(rng.choices(WORDS, k=9)).capitalize() + "." for _ in range(rng.randrange(12, 40)))
        if k < 12:  # cut in a signature
            text = text[:583] + "\nSigned: Ann Smithfie"[: 600 - 583]
        elif k < 60:
            text += f"\nSigned: Ann {rng.choice(['Smithfield', 'Smithson', 'Smithers'])}"
        elif k < 100:  # cut in a sentence, by the same limit or during transfer
            text = text[: 600 if k % 2 else 300 + k].rstrip(". ")
        if k < 12 or 60 <= k < 100:
            want.add(f"s_page_{k:03d}")
        rows.append(audit_row(f"s_page_{k:03d}", text))
    rows += [audit_row(f"t_page_{k}", "Ann Smithfield, Smithson and Smithers were seen.") for k in range(9)]
    folder = written_tables(audit_trail=rows)

    def cut():
        return {r.page_key for r in QUERIES["p1_found"](spark, folder).collect()}

    found = cut()
    assert (found - want, want - found) == (set(), set())
    monkeypatch.setattr(truncation, "EVIDENCE", ("ending",))
    monkeypatch.setattr(truncation, "WHOLE", truncation.WHOLE[2:])
    monkeypatch.setattr(truncation, "CUT_PAGES", truncation.CUT_PAGES[2:])
    assert cut() == {key for key in want if key >= "s_page_060"}  # without trie and length


def test_fragments_of_words_grow_with_the_corpus(spark, written_tables):
    """Pages cut in the same word stay cut, however many there are and though pages that break off hold the fragment inside."""
    rng = random.Random(8)
    words = [*WORDS, "meltranol", "Parkingham's"]
    body = lambda: " ".join(" ".join(rng.choices(words, k=9)).capitalize() + "." for _ in range(rng.randrange(12, 40)))
    ends = {"cut": " He took meltra", "broken": " He took meltra &am", "name": " Known to have Parkingham's", "whole": "\nKeep this sheet near Brammel Hospital"}
    rows = [audit_row(f"s{k % 20}_page_{k:04d}", body() + (ends[name] if name else "")) for k, name in enumerate(["cut"] * 8 + ["broken"] * 7 + ["name"] * 4 + ["whole"] * 50 + [""] * 1500)]
    rows += [audit_row(f"s{k % 20}_page_{k:04d}", "Seen at Brammel Hospital. " + body()) for k in range(2000, 2200)]
    folder = written_tables(audit_trail=rows, patient_data_extractor=[(k, "s", None, 0, "t", True, ["Parkingham's", "Brammel Hospital"], None) for k in range(3)])
    found = {int(r.page_key[-4:]) for r in QUERIES["p1_found"](spark, folder).collect()}
    assert found == set(range(19))


def test_long_last_lines_are_read_whole():
    trie = truncation.Trie(sorted(["the", "wound"]))
    row = "| " + "a cell of a long row | " * 60
    assert truncation.tail_features(f"Test\n{row}", trie, lambda w: "", "7")[3] == "table"
    assert truncation.last_lines("one\ntwo\n\nthree \n") == "two\n\nthree" and truncation.last_lines("x" * 9000) == "x" * 9000
    for text in ("a b c", "", "-- !", "w " * 3000, "x" * 5000 + " y z", "one two three four five six seven"):
        assert truncation.last_tokens(text, 6) == truncation.TOKENS.findall(text)[-6:]


# ---- 2


def test_the_field_decides_in_every_field(spark, data, monkeypatch):
    """Without what is learned there are other rows of every kind; without skip edges there are other rows."""
    whole = {tuple(r) for r in QUERIES["p2_found"](spark, data).collect()}
    fit = pii.fit

    def without(**parts):
        def fitted(documents, v):
            field = fit(documents, v)
            for name in parts:
                getattr(field, name)[:] = 0
            return field

        monkeypatch.setattr(pii, "fit", fitted)
        return {tuple(r) for r in QUERIES["p2_found"](spark, data).collect()}

    lost = whole - without(weights=0, chain=0, skip=0)
    assert {r[1] for r in lost} == {"clean_ocr", "final_llm_scrubbed", "extracted_identifiers"} and {r[2] for r in lost} == {"email", "phone", "id_number", "address", "name"}


def test_skip_edges_are_trained_and_change_labels():
    """A name seen in clear contexts is known again where nothing tells it, because its weight was trained with the edges."""
    words = {w: 50 for w in "handed over to the seen by was in on and with after lunch ward bed nine".split()}
    names = [f"qu{WORDS[k]}" for k in range(80)]
    v = pii.Vocabulary(frozenset(words), words, {}, {})
    documents = []
    for k, name in enumerate(names[:60]):
        listed = [f"Mr {name.title()}"] if k % 2 else []
        lead = "seen by Mr" if k % 2 else "in bed"
        documents.append((f"{lead} {name.title()} was on the ward and with {name.title()} after lunch", listed + ([name.title()] if k % 2 else [])))
    field = pii.fit(documents, v)
    assert abs(field.skip).max() > 0.1 and abs(field.chain).max() >= 0
    text = f"seen by Mr {names[70].title()} after lunch and with {names[70].title()} after lunch"
    nodes = pii.nodes_of(text, v)[0]
    tied = field.decode([nodes])[0][1]
    field.skip[:] = 0
    assert abs(tied - field.decode([nodes])[0][1]).max() > 0.01


def test_identifiers_joined_and_broadcast_are_equal(spark, data, monkeypatch):
    """What p2 knows about ordinary words and names doesn't depend on whether the vocabulary can be broadcast."""
    broadcast = {tuple(r) for r in QUERIES["p2_found"](spark, data).collect()}
    monkeypatch.setattr(common, "MAX_FREQUENT", 50)
    assert {tuple(r) for r in QUERIES["p2_found"](spark, data).collect()} == broadcast


def test_addresses_without_postcode():
    v = pii.Vocabulary(frozenset({"and", "with"}), {"and": 9, "with": 9, "caldmere": 9}, {}, {})
    for text, want in (("Lives at 156 Tansy Terrace, Caldmere with a relative", "156tansyterracecaldmere"), ("Lives at 156 Tansy Terrace, and with a relative", None), ("Lives at 7 Mill Lane, Oldtown AB1 2CD", "7milllaneoldtownab12cd")):
        assert [pii.plain(text[a:b]) for a, b, _ in pii.recognised(text, v.usual)[0]] == ([want] if want else [])
    assert pii.element_identifiers("156 Tansy Terrace, Caldmere", v) == [("address", "156tansyterracecaldmere")]
