"""The operators against hand-made cases and brute force."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import common, encoding, leakage, lookalikes, markup, name_variants, pii, queries, repetition, scan_repair, site_lines, truncation

from .conftest import audit_row

# ---- shared


def test_repairer():
    fix = common.Repairer({"started": 100, "persistent": 50, "on": 500, "modem": 9, "modern": 90})
    assert fix("startecl") == "started" and fix("perslstent") == "persistent" and fix("started") == ""
    assert fix("unknown") == "" and fix("modem") == ""  # itself known well enough


def test_frequent_is_bounded(spark):
    texts = spark.createDataFrame([("a a a b b c",), (None,), ("",)], "t string")
    counts = common.counted(texts, str.split)
    assert {r.token: r.n for r in counts.collect()} == {"a": 3, "b": 2, "c": 1}
    assert common.frequent(counts, most=2, least=1) == {"a": 3}  # at most two tokens can have half of all occurrences
    assert common.frequent(counts, most=100, least=2) == {"a": 3, "b": 2}


def test_broken_words():
    text = "the wo-\n und was fluct‐\nuating - \n not-\n\nthis, Pellham-\nTarn"
    assert [(text[a:b], text[c:d]) for a, b, c, d in common.broken_words(text)] == [("wo", "und"), ("fluct", "uating"), ("Pellham", "Tarn")]
    assert common.inner_tokens("a wo-\nund b c") == ["a", "b"]


def test_written_uses_the_shared_folder(spark):
    rows = common.written(spark.range(3), "t")
    assert rows.count() == 3 and any(spark.conf.get("spark.checkpoint.dir") in f for f in rows.inputFiles())


# ---- 1


def test_tails():
    trie = truncation.Trie(sorted(["sodium", "settles", "stayed", "wound", "albumin", "the", "on", "smith", "mmol/l", "check"]))

    def form(text, number="7"):
        return truncation.tail_features(text, trie, lambda w: "", number)[3]

    assert form("Discharge once sodium settles.") == "sentence"
    assert form("the wound on th") == "open" and truncation.tail_features("the wou", trie, lambda w: "", "")[5]
    assert form("the wound o…") == "broken" and form("the wound &nbs") == "broken" and form("the wound o�") == "broken"
    assert form("It went.\nSigned: Dr A Smith, consultant") == "signature"
    assert form("It went.\n1. Check sodium\n2. Check albumin") == "list" and form("It went.\n2. Check albu") == "open"
    assert form("It went.\nSodium 5.1 mmol/L") == "result"
    assert form("Test\n| a | 1 |") == "table"
    assert form("It went.\n- 7 -") == "number" and form("It went.\npage 3 of 9") == "number"
    assert form("<p>It went.</p>") == "sentence"
    assert form("Handed over to Dr.") == "open"


def test_truncated_pages(spark, written_tables):
    body = "The wound on the thigh stayed clean after surgery and sodium settles within days of this visit. "
    rng = random.Random(3)
    rows = []
    for k in range(1, 61):
        text = "".join(rng.choice((body, "Albumin stayed near the usual level and the ward round went on as planned. ")) for _ in range(6)).strip()
        if k % 10 == 0:
            text = text[: 200 + 7 * (k // 10)].rstrip(". ")
        elif k % 3 == 0:
            text += "\nKeep this sheet in the blue folder by the door"
        rows.append(audit_row(f"s_page_{k:02d}", text))
    folder = written_tables(audit_trail=rows)
    found = {r.page_key for r in queries.p1_found(spark, folder).collect()}
    assert found == {f"s_page_{k:02d}" for k in range(10, 61, 10)}
    share = queries.p1_share(spark, folder).first()
    assert (share.pages, share.cut_pages, share.cut_share) == (60, 6, 0.1)


# ---- 2


def test_numbers_and_addresses():
    text = "Tel. 0161 496\n0882, NHS 943 476 5919, NI QQ 12 34 56 A, MRN RX0431625, mail jo.x [at] home [dot] example. Lives at Flat 3, 12 Mill Lane, Oldtown AB1 2CD now, or 7 High Street, and"
    sure, numbers = pii.recognised(text, {"and": 1})
    assert [(k, pii.plain(text[a:b])) for a, b, k in sorted(sure)] == [("email", "joxathomedotexample"), ("address", "flat312milllaneoldtownab12cd")]
    assert [(k, pii.plain(text[a:b])) for a, b, k in numbers] == [("phone", "01614960882"), ("nhs", "9434765919"), ("ni", "qq123456a"), ("unit", "rx0431625")]
    assert pii.valid_nhs("9434765919") and not pii.valid_nhs("9434765918")


VOCABULARY = pii.Vocabulary(frozenset(), {w: 50 for w in "handed over to after the seen by no left knee tuesday page of mrs".split()}, {"ann": 9, "smith": 9, "jones": 5}, {"ewold": 9})


@pytest.mark.parametrize(
    ("element", "want"),
    [
        ("Mrs Ann Smith", [("name", "annsmith")]),
        ("Smith, Dr Ann", [("name", "smithann")]),
        ("A Smith, tel 0161 496 0882", [("phone", "01614960882"), ("name", "asmith")]),
        ("left knee", []),
        ("St Ewold's Hospital", []),
        ("943 476 5919", [("id_number", "9434765919")]),
        ("943 476 5918", []),
        ("", []),
        ("***", []),
    ],
)
def test_elements(element, want):
    assert pii.element_identifiers(element, VOCABULARY) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Handed over to Ann Smith after", ["annsmith"]),
        ("Handed over to Smith, Mrs Ann after", ["smithann"]),
        ("seen by A. Smith, no", ["asmith"]),
        ("seen by Smith A\nthe", ["smitha"]),
        ("Mrs Smith. Jones the", ["smith"]),
        ("Smith the", []),  # a surname alone, without a title
        ("Ann\nSmith over", ["annsmith"]),
    ],
)
def test_name_grammar(text, want):
    nodes, _, spans = pii.nodes_of(text, VOCABULARY)
    labels = [1] * len(nodes)
    assert ["".join(pii.plain(text[a:b]) for a, b in parts) for _, _, parts in pii.names_in(text, nodes, labels, spans)] == want


def brute_marginals(unary, edges):
    import itertools

    import numpy as np

    n, labels = unary.shape
    total = np.zeros((n, labels))
    for states in itertools.product(range(labels), repeat=n):
        p = np.exp(sum(unary[k, s] for k, s in enumerate(states)) + sum(m[states[a], states[b]] for a, b, m in edges))
        for k, s in enumerate(states):
            total[k, s] += p
    return total / total.sum(1, keepdims=True)


def test_message_passing_is_exact_on_chains():
    import numpy as np

    rng = np.random.default_rng(0)
    unary, chain = rng.normal(size=(4, 4)), rng.normal(size=(4, 4))
    field = pii.Field({}, np.zeros((1, 4)), chain, np.zeros((4, 4)))
    rounds = pii.ROUNDS
    pii.ROUNDS = 60
    try:
        got = field._propagate(unary, [([(0, 1), (1, 2), (2, 3)], chain), ([], chain)])
    finally:
        pii.ROUNDS = rounds
    assert np.allclose(got, brute_marginals(unary, [(0, 1, chain), (1, 2, chain), (2, 3, chain)]), atol=1e-6)


def test_skip_edges_pull_labels_together():
    import numpy as np

    agree = 3 * np.eye(4)
    field = pii.Field({"sure": 0}, np.array([[0, 4.0, 0, 0]]), np.zeros((4, 4)), agree)
    nodes = [pii.Node(0, 5, "word", "quilestrup", ["sure"], False), pii.Node(9, 14, "word", "quilestrup", [], False), pii.Node(20, 25, "word", "quileestrup", [], False), pii.Node(30, 35, "word", "other", [], False)]
    belief = field.decode([nodes])[0]
    assert belief[1, 1] > 0.7 and belief[2, 1] > 0.5 and belief[3, 1] < 0.5


# ---- 3


def brute_share(words):
    covered = set()
    for i in range(len(words) - 5):
        if any(words[j : j + 6] == words[i : i + 6] for j in range(i)):
            covered.update(range(i, i + 6))
    return len(covered)


@given(st.lists(st.sampled_from("abc"), max_size=60))
@settings(max_examples=150, deadline=None)
def test_repeated_words(words):
    assert repetition.repeated_words(words)[0] == brute_share(words)


def test_weak_supervision_finds_reliable_rules():
    rng = random.Random(0)
    patterns: dict = {}
    for _ in range(5000):
        bad = rng.random() < 0.1
        votes = tuple((1 if bad else -1) if rng.random() < 0.9 else (-1 if bad else 1) for _ in range(4)) + (rng.choice((-1, 1)),)
        patterns[votes] = patterns.get(votes, 0) + 1
    model = repetition.fit_rules(list(patterns.items()))
    assert 0.05 < model["prior"][1] < 0.15
    assert repetition.posterior(model, (1, 1, 1, 1, -1)) > 0.95 and repetition.posterior(model, (-1, -1, -1, -1, 1)) < 0.01
    assert abs(model["table"][1, 4, 2] - 0.5) < 0.15  # the fifth rule knows nothing


# ---- 4


@pytest.mark.parametrize(("a", "b", "same"), [("keep this sheet in the folder", "keep this shcet in the folder", True), ("keep this sheet in the folder", "keep that sheet in the drawer", False), ("keep this sheet in the folder", "keep this sheet in the", False)])
def test_wordings(a, b, same):
    assert site_lines.same_wording(a.split(), b.split()) is same
    assert (site_lines.Matcher([a])(b) == 0) is same


def test_wording_form():
    assert site_lines.wording("* KEEP  this sheet, no 12, in the folder!") == "keep this sheet no in the folder"
    assert site_lines.wording("page 3 of 9") == "" and site_lines.wording("") == ""


def test_summaries_keep_heavy_hitters():
    s = site_lines.Summary()
    rng = random.Random(1)
    for k in range(8000):
        s.add({f"line {rng.random()}", *(["the printed line"] if k % 4 == 0 else [])})
    assert len(s.counts) <= 2 * site_lines.CAPACITY and s.error > 0
    assert 2000 - s.error <= s.counts["the printed line"] <= 2000


def test_printed_lines_by_brute_force(spark, written_tables):
    rng = random.Random(5)
    rows, want = [], set()
    for stem, share in (("a", 0.5), ("b", 0.15), ("c", 1.0)):
        n = 4 if stem == "c" else 40
        for k in range(n):
            lines = [f"The visit of {rng.choice('abcdefgh')} number {rng.choice('pqrstuvw')} took {rng.choice('xyz')} and {rng.random()} went home" for _ in range(4)]
            if rng.random() < share or stem == "c":
                line = f"Please return this sheet {k} to the records library"
                lines.insert(2, line.replace("sheet", "shcet") if k % 7 == 0 else line.upper() if k % 5 == 0 else line)
                if stem == "a":
                    want.add((f"a_page_{k:02d}", 3))
            rows.append(audit_row(f"{stem}_page_{k:02d}", "\n".join(lines)))
    folder = written_tables(audit_trail=rows)
    got = {(r.page_key, r.line_no) for r in queries.p4_found(spark, folder).collect() if "records" in dict((x[0], x[1]) for x in rows)[r.page_key].lower().split("\n")[r.line_no - 1]}
    assert got == want  # b is below the share, c has too few pages
    clean = {r.page_key: r.text for r in queries.p4_clean(spark, folder).collect()}
    assert all("records library" not in clean[k].lower() for k, _ in want)


# ---- 5


def fixer():
    words = {w: 100 for w in "weekend fluctuating self-limiting started the was helped non-tender after".split()}
    return scan_repair.Fixer(words, frozenset({"ashmenholt"}), frozenset({"the", "was"}))


def test_faults():
    text = "the week¬\nend, was startecl\nself-\nlimiting and non-te-\nnder the helpcd helpcd\nAshmenho1t was"
    assert sorted(scan_repair.faults(text, fixer())) == [("hyphen", 1, "weekend"), ("hyphen", 3, "self-limiting"), ("hyphen", 4, "non-tender"), ("misread", 2, "started"), ("misread", 5, "helped")]


def test_number_lines():
    assert scan_repair.line_numbers("- 4 -\ntext\n\npage 4 of 9\n") == [(1, 4, True), (4, 4, True)]
    assert scan_repair.line_numbers("peak flow\n316.\n[see film\n21].\nend") == []


def test_repaired_page():
    text = "Header line of the house here now\nthe wound was\nstartecl and fluc-\ntuating after.\n\n- 4 -"
    matcher = site_lines.Matcher(["header line of the house here now"])
    got = scan_repair.repaired(text, [6], matcher, fixer())
    assert got.split() == "the wound was started and fluctuating after.".split()
    assert scan_repair.repaired(None, [], None, fixer()) is None


# ---- 6


@pytest.mark.parametrize(
    ("a", "b", "near"),
    [("ashmenholt", "ashmmenholt", True), ("ingleennocke", "illgeennocke", True), ("jarrosgill", "tarrosgill", False), ("hild", "hidl", True), ("hild", "hold", True), ("smith", "smithers", False)],
)
def test_near_names(a, b, near):
    assert name_variants.near(a, b) is near
    if near:
        assert name_variants.deletes(a) & name_variants.deletes(b)  # the index finds every near pair


@given(st.text(alphabet="abcd", min_size=1, max_size=8), st.text(alphabet="abcd", min_size=1, max_size=8))
@settings(max_examples=300, deadline=None)
def test_delete_index_is_complete(a, b):
    if name_variants.near(a, b):
        assert name_variants.deletes(a) & name_variants.deletes(b)


def test_variants(spark, written_tables):
    lists = [["Margaret Holmen", "Miss M Holmen;", "HOLMEN, Margaret T.", "Peggy Holmmen"], ["Dorothy Holmen", "Dot Holmen"], ["St Ewold's Eye Hospital", "the St. Ewolds Eye Hosp.", "SEEH", "St Ewold's Surgery"], ["A Smith, tel 0161 496 0882", None, ""]]
    rows = [(k, "s", f"s_page_0{k}", 0, "t", True, x, None) for k, x in enumerate(lists)]
    folder = written_tables(patient_data_extractor=rows, audit_trail=[audit_row("s_page_01", "t", entities=["margaret holmen"])])
    found = {}
    for r in queries.p6_variants(spark, folder).collect():
        found.setdefault(r.entity, set()).add(r.name)
    groups = {frozenset(v) for v in found.values()}
    assert frozenset(["Margaret Holmen", "Miss M Holmen;", "HOLMEN, Margaret T.", "Peggy Holmmen", "margaret holmen"]) in groups
    assert frozenset(["Dorothy Holmen", "Dot Holmen"]) in groups
    assert frozenset(["St Ewold's Eye Hospital", "the St. Ewolds Eye Hosp.", "SEEH"]) in groups
    pairs = {(r.name_a, r.name_b) for r in queries.p6_found(spark, folder).collect()}
    assert len(pairs) == 10 + 1 + 3 and all(a < b for a, b in pairs)


# ---- 7


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("<p>A &amp; b</p>", ["html"]),
        ("<!-- region -->", ["html"]),
        ("a ** b, 3 * 4, # 5, $5, < 7, > 3, & more [see film 3]\n* a bullet\n1. one", []),
        ("## Head\n**bold**", ["markdown"]),
        ("| a | b |\n|---|:-:|", ["markdown"]),
        ("== Head ==\n'''x''' [[a|b]] {{cn}}", ["wiki"]),
        (r"\section*{A} $\frac{1}{2}$ \item x", ["latex"]),
        ("<b>x</b> == H == ", ["html", "wiki"]),
        ("", []),
    ],
)
def test_kinds(text, kinds):
    assert markup.kinds_of(text, markup.DEFAULT) == kinds
    assert bool(markup.SUSPECTED.search(text)) or not kinds


def test_tree_messages_are_exact():
    import itertools
    import math

    root = markup.parse("<div><p>x</p> **b** <ul><li>y</li></ul></div> == H ==")
    model = {**markup.DEFAULT, "rate": {"tag": 0.3, "strong": 0.2, "wheading": 0.7, "tag p closed": 0.9}}
    markup.infer(root, model)
    nodes = [root, *root.all()]
    parents = {id(c): n for n in nodes for c in n.children}
    total = {id(n): [0.0, 0.0] for n in nodes}
    for states in itertools.product((0, 1), repeat=len(nodes)):
        of = {id(n): s for n, s in zip(nodes, states)}
        p = 1.0
        for n in nodes:
            rate = model["page"] if n is root else model["rate"].get(n.type, model["rate"].get(n.kind, model["unknown"]))
            p *= rate if of[id(n)] else 1 - rate
            if n is not root:
                up = parents[id(n)]
                tie = model["same"] if markup.DIALECT.get(n.kind) == markup.DIALECT.get(up.kind) else model["other"]
                p *= tie if of[id(n)] == of[id(up)] else 1
        for n in nodes:
            total[id(n)][of[id(n)]] += p
    for n in nodes:
        assert math.isclose(n.marginal, total[id(n)][1] / sum(total[id(n)]), rel_tol=1e-9)


def test_clean_markup():
    text = "<h2>Plan</h2><ul><li>one</li><li>two</li></ul><table><tr><th>a</th><td>1</td></tr></table> A &lt; B <!-- x -->"
    assert markup.clean_text(text, markup.DEFAULT) == "## Plan\n\n- one\n- two\n\n| a | 1 |\n A < B"
    assert markup.clean_text(r"\section{A} \textbf{b} $\frac{1}{2}$", markup.DEFAULT) == r"# A b $\frac{1}{2}$"
    assert markup.clean_text("[[x|the y]] '''z''' `code`", markup.DEFAULT) == "the y z `code`"
    assert markup.clean_text("plain < 5", markup.DEFAULT) == "plain < 5" and markup.clean_text(None, markup.DEFAULT) is None


def test_fit_learns_what_disappears():
    pairs = [("<p>a</p> x **b**", "a x **b**")] * 50
    rate = markup.fit(pairs)["rate"]
    assert rate["tag p closed"] > 0.8 and rate["strong"] < 0.3


# ---- 8


def test_ids_equal_the_plain_encoder():
    tokenizers = pytest.importorskip("tokenizers")
    plain = tokenizers.Tokenizer.from_file(f"{encoding.TOKENIZERS}/byte_bpe_50k.json")
    plain.encode_special_tokens = True
    encode = encoding.Encoder(encoding.load_ranks())
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice("aábB 1²'’!-.,\n\t\r  東я́s'llre…🙂_\xa0　<|endoftext|>") for _ in range(rng.randint(0, 40)))
        assert encode(text) == plain.encode(text, add_special_tokens=False).ids, repr(text)
        assert "".join(encode.fragments(text)) == text
    assert encode("") == [] and encode(None) == []
    assert len(encode.fragments("one two three")) == 3


# ---- 9


def test_leaks(spark, written_tables):
    words = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango".split()
    item = " ".join(words)
    texts = {
        1: f"before {item} after",
        2: f"half of it {' '.join(words[:11])} and other things",
        3: f"a short quotation {' '.join(words[:6])} is none",
        4: "Alpha, BRAVO: charlle delta echо foxtrot golf hotel change juliet kilo lima mike november",
        5: " ".join(w for pair in zip(words, ["x"] * 20) for w in pair),
        6: None,
        7: "",
    }
    folder = written_tables(documents=[(k, t, None, None, None, None, None, None) for k, t in texts.items()], eval_items=[(9, "s", item, "A"), (10, "s", None, "B"), (11, "s", "", "C")])
    got = {(r.doc_id, r.item_id) for r in queries.p9_found(spark, folder).collect()}
    assert got == {(1, 9), (2, 9), (4, 9)}
    clean = {r.doc_id: r.text for r in queries.p9_clean(spark, folder).collect()}
    assert clean[1] == "before after" and clean[3] == texts[3] and clean[6] is None and len(clean) == 7


def test_join_path_equals_broadcast(spark, written_tables, monkeypatch):
    words = [f"w{k}" for k in range(30)]
    texts = [(1, " ".join(words)), (2, " ".join(words[10:])), (3, "none"), (4, " ".join(words[:10]))]
    folder = written_tables(documents=[(k, t, None, None, None, None, None, None) for k, t in texts], eval_items=[(1, "s", " ".join(words), ""), (2, "s", "other words are here in this one", "")])
    one = sorted(tuple(r) for r in queries.p9_leaks(spark, folder).collect())
    monkeypatch.setattr(leakage, "BROADCAST_WINDOWS", 0)
    assert sorted(tuple(r) for r in queries.p9_leaks(spark, folder).collect()) == one and len(one) == 2


# ---- 10

SENTENCE = "The patient declined angiogram after surgery but agreed to lactate sampling, and the ward round went on without any change in the plan."


def test_look_alikes(spark, written_tables, monkeypatch):
    cyrillic = SENTENCE.replace("patient", "раtіеnt").replace("on ", "оn ")
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in SENTENCE)
    texts = {
        1: SENTENCE,
        2: cyrillic,
        3: SENTENCE.replace(" ", "\xa0").replace("agreed", "agr​eed"),
        4: wide,
        5: SENTENCE,
        6: SENTENCE.replace("The", "the"),
        7: SENTENCE.replace("any", "a"),
        8: "short",
        9: "ѕhort",
        10: "Пациент отметил боль в груди после операции, но согласился на анализ крови, и обход продолжился без изменений плана.",
        11: None,
    }
    folder = written_tables(documents=[(k, t, None, None, None, None, None, None) for k, t in texts.items()])
    want = {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (2, 5), (3, 5), (4, 5)}
    got = [(r.doc_id_a, r.doc_id_b) for r in queries.p10_found(spark, folder).collect()]
    assert set(got) == want and len(got) == len(want)
    forms = {r.doc_id: r.text for r in queries.p10_canonical(spark, folder).collect()}
    assert forms[2] == forms[4] == SENTENCE and forms[10] == texts[10] and forms[11] is None
    monkeypatch.setattr(lookalikes, "BROADCAST_WORDS", -1)
    assert {(r.doc_id_a, r.doc_id_b) for r in queries.p10_found(spark, folder).collect()} == want


def test_repair_needs_a_corpus_word():
    text = "a quіlt"
    assert lookalikes.repaired(text, {"quilt"}.__contains__) == "a quilt" and lookalikes.repaired(text, set().__contains__) == text
    assert lookalikes.folded("ﬁne　ｔｅｘｔ­­") == "fine text"


def test_join_path_of_printed_lines(spark, written_tables, monkeypatch):
    rows = [audit_row(f"a_page_{k:02d}", f"Please return this sheet {k} to the records library\nline {k}") for k in range(8)]
    folder = written_tables(audit_trail=rows)
    one = {tuple(r) for r in queries.p4_found(spark, folder).collect()}
    monkeypatch.setattr(site_lines, "BROADCAST_CANDIDATES", -1)
    assert {tuple(r) for r in queries.p4_found(spark, folder).collect()} == one == {(f"a_page_{k:02d}", 1) for k in range(8)}


def test_scrubbed_pages_are_readable(spark, data):
    rows = queries.p2_scrubbed(spark, data).where("text like '%[NAME]%'").limit(20).collect()
    assert rows and all(re.search(r"\[(NAME|PHONE|EMAIL|ADDRESS|ID_NUMBER)\]", r.text) for r in rows)
