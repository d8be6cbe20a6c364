"""The text operators on fixtures, against brute force, round trips and held-out labels."""

import math
import random
from collections import Counter
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from resma.llm import areas, mixing, packing, pii, queries, scans, tokens


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, data, name):
    frame = queries.QUERIES[name](spark, data)
    assert frame.count() >= 0
    if name.endswith("_found"):
        assert frame.columns == {"p1_found": ["page_id", "line_no", "kind"], "p5_found": ["page_id", "kind", "start_pos"], "p9_found": ["doc_id", "area"]}[name]


# --- tokens


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é,.-'\n\t 12中 ", max_size=60))
def test_sizes_are_exact(text):
    encode = tokens.encoding(tokens.TOKENIZERS, tokens.VOCABULARY).encode_ordinary
    assert tokens.counter(tokens.TOKENIZERS, tokens.VOCABULARY)(text) == len(encode(text))


def test_sizes_of_tables(spark):
    frame = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "uma frase", 7), (4, "palavra " * 50_000, 8)], "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.with_tokens(frame).collect()}
    assert got[1] == got[2] == 0 and got[3] > 0 and got[4] >= 50_000


# --- packing


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=12))
def test_patterns_hold_every_length_once(histogram):
    patterns = packing.shortest_pack_first(histogram, 40)
    held = Counter()
    for p in patterns:
        assert sum(p.items) <= 40 and p.count > 0
        for x in p.items:
            held[x] += p.count
    assert held == Counter(histogram)


def one_by_one(lengths, capacity):
    """Serial statement: each length into the pack with most room, else a new pack."""
    rooms = []
    for x in sorted(lengths, reverse=True):
        k = max(range(len(rooms)), key=lambda i: rooms[i], default=None)
        if k is None or rooms[k] < x:
            rooms.append(capacity - x)
        else:
            rooms[k] -= x
    return len(rooms)


def test_as_many_packs_as_one_by_one():
    rnd = random.Random(5)
    for _ in range(20):
        lengths = [rnd.randrange(1, 64) for _ in range(rnd.randrange(1, 400))]
        packs = sum(p.count for p in packing.shortest_pack_first(Counter(lengths), 64))
        assert abs(packs - one_by_one(lengths, 64)) <= max(1, packs // 50)


def test_packed_pieces(spark):
    rnd = random.Random(2)
    sizes = [rnd.choice([7, 7, 7, 100, 700, 2048, 5000, 0]) for _ in range(600)]
    frame = spark.createDataFrame([*enumerate(sizes), (9999, None)], "doc_id long, n_tokens int")
    rows = packing.pack(frame.withColumn("piece", F.lit(1))).collect()
    by_doc, by_container = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        if r["container"] is not None:
            by_container.setdefault(r["container"], []).append(r)
    assert len(by_doc) == 601
    for doc, pieces in by_doc.items():
        assert sum(p["piece_tokens"] for p in pieces) == (sizes[doc] if doc < 600 else 0)
        assert len(pieces) == max(1, -(-(sizes[doc] if doc < 600 else 0) // 2048))
        assert all((p["container"] is None) == (p["piece_tokens"] == 0) for p in pieces)
    for pieces in by_container.values():
        pieces.sort(key=lambda r: r["place"])
        assert [p["place"] for p in pieces] == list(range(len(pieces)))
        at = 0
        for p in pieces:
            assert p["start"] == at
            at += p["piece_tokens"]
        assert at == pieces[0]["fill"] <= 2048
    again = packing.pack(frame.repartition(9)).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["container"] or -1, r["place"] or -1)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert packing.pack(frame.limit(0)).count() == 0


# --- mixing


def test_shares_and_caps(spark):
    rnd = random.Random(1)
    docs = [(i, "big" if i % 3 else "mid", rnd.randrange(50, 500)) for i in range(3000)] + [(5000 + i, "tiny", 100) for i in range(30)] + [(9000, "other", 10), (9001, None, 10), (9002, "big", 0)]
    sized = spark.createDataFrame(docs, "doc_id long, source string, n_tokens int")
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.39, 2), ("tiny", 0.1, 4), ("none", 0.01, 1)], "source string, target_share double, max_repeats int")
    selection, shares = mixing.mix(sized, targets, rows=20)
    got = {r["source"]: r for r in shares.collect()}
    for name, want in (("big", 0.5 / 0.99), ("mid", 0.39 / 0.99), ("tiny", 0.1 / 0.99)):
        assert abs(got[name]["actual_share"] - want) < 0.02
    assert got["none"]["selected_tokens"] == 0 and got["tiny"]["most_repeats"] <= 4 and got["tiny"]["documents"] == 30
    rows = selection.collect()
    caps = {"big": 1, "mid": 2, "tiny": 4}
    assert all(1 <= r["repeats"] <= caps[r["source"]] for r in rows) and len({r["doc_id"] for r in rows}) == len(rows)
    total = sum(r["n_tokens"] * r["repeats"] for r in rows)
    assert total == sum(r["selected_tokens"] for r in got.values())
    some, part = mixing.mix(sized, targets, budget=5000, rows=20)
    assert 4000 <= sum(r["selected_tokens"] for r in part.collect()) <= 5000
    same = {(r["doc_id"], r["repeats"]) for r in mixing.mix(sized.repartition(7), targets, rows=20)[0].collect()}
    assert same == {(r["doc_id"], r["repeats"]) for r in rows}
    empty, none = mixing.mix(sized.limit(0), targets)
    assert empty.count() == 0 and none.count() == 4
    assert mixing.mix(sized, targets.limit(0))[0].count() == 0


def test_copies_count_as_one_text(spark):
    sized = spark.createDataFrame([(i, "s", 10, i // 2) for i in range(20)], "doc_id long, source string, n_tokens int, h long")
    targets = spark.createDataFrame([("s", 1.0, 3)], "source string, target_share double, max_repeats int")
    rows = mixing.mix(sized, targets, text_hash=("h",))[0].collect()
    assert {r["doc_id"] for r in rows} == set(range(0, 20, 2)) and {r["repeats"] for r in rows} == {3}


# --- personal data

LEXICON = pii.Lexicon(names={"lindalva", "nevrões", "teodora", "varjal", "valmir", "osmindo", "itacurá", "celhares"}, towns={"nova": {("nova", "varjal")}, "serra": {("serra", "mansa")}, "campo": {("campo", "itacurá")}})

PII_CASES = [
    ("Nome: VALMIR DOS OSMINDO VALDROSO\nR.G. 8009422", [("name", "VALMIR DOS OSMINDO VALDROSO"), ("id_number", "8009422")]),
    ("o Sr. Valmir Celhares relatou", [("name", "Valmir Celhares")]),
    ("Testemunha: Teodora D. Osmindo", [("name", "Teodora D. Osmindo")]),
    ("subscreve T. V. NEVRÕES, CPF nº 949.930.865-50.", [("name", "T. V. NEVRÕES"), ("id_number", "949.930.865-50")]),
    ("o depoimento de Lindalva\nNevrões confirma", [("name", "Lindalva\nNevrões")]),
    ("Autos em Nova Varjal, 3 de junho", []),
    ("Construtora Osmindo & Filhos Ltda | via do cliente", []),
    ("Faculdade Itacurá Ltda foi intimada", []),
    ("E-mail: ubirema+jandira@post.example.net.", [("email", "ubirema+jandira@post.example.net")]),
    ("escreveu a clovis334 @ mensagens.invalid e", [("email", "clovis334 @ mensagens.invalid")]),
    ("maria (arroba) correio.example", [("email", "maria (arroba) correio.example")]),
    ("atendimento gratuito pelo ouvidoria@aroeira.example.", []),
    ("adot@da.\n\nConsta dos autos", []),
    ("Fone +55 70 93351-7687", [("phone", "+55 70 93351-7687")]),
    ("retorno: (52)\n92766-9635.", [("phone", "(52)\n92766-9635")]),
    ("26 958841783 - ligou", [("phone", "26 958841783")]),
    ("Celular 5520964365942", [("phone", "5520964365942")]),
    ("Banco Cravina S.A. - Ouvidoria: 0800 910 5371", []),
    ("Central de Vendas Banco Cravina S.A.: (70) 3951-0910, balcão", []),
    ("CNPJ 94.510.637/0001-65, com sede na Praça dos Tropeiros, 1124, CEP 00296-053.", []),
    ("Processo nº 0000006-23.2024.8.05.9161; Protocolo 57683808735; Proposta número 061128390-0", []),
    ("End. Praça Beira Canal, s/n, CEP 99304-913", [("address", "Praça Beira Canal, s/n, CEP 99304-913")]),
    ("mora em Sítio Riacho Longo, s/n, zona rural.", [("address", "Sítio Riacho Longo, s/n, zona rural")]),
    ("morador da Rua Teodora Varjal, nº 10, apto 3, Serra Mansa, doravante", [("address", "Rua Teodora Varjal, nº 10, apto 3, Serra Mansa")]),
    ("benefício nº 316.425.010-4", [("id_number", "316.425.010-4")]),
    ("____ Valmir Celhares / 77944045440", [("name", "Valmir Celhares"), ("id_number", "77944045440")]),
    ("", []),
]


@pytest.mark.parametrize(("given", "want"), PII_CASES)
def test_values_found(given, want):
    assert [(k, given[s:e]) for k, s, e in pii.Finder(LEXICON).find(given)] == want


def test_very_long_text():
    text = "sem dados pessoais aqui. " * 20_000 + "Fone +55 70 93351-7687"
    assert [k for k, _, _ in pii.Finder(LEXICON).find(text)] == ["phone"]


KEY = b"k" * 32


def test_feistel_is_a_permutation():
    for n in (1, 2, 3):
        seen = {pii.feistel(f"{i:0{n}d}", KEY) for i in range(10**n)}
        assert len(seen) == 10**n and all(len(x) == n for x in seen)


@given(st.text(alphabet="0123456789", max_size=20))
def test_feistel_round_trip(digits):
    assert pii.unfeistel(pii.feistel(digits, KEY, b"t"), KEY, b"t") == digits


def test_pseudonyms_keep_format_and_link():
    a, b = pii.permute_number("529.982.247-25", KEY, "id_number"), pii.permute_number("52998224725", KEY, "id_number")
    assert a != "529.982.247-25" and a[3] == "." and "".join(filter(str.isdigit, a)) == b
    assert pii.cpf_check(b[:9]) == b[9:]
    assert pii.permute_number("+55 71 98888-0000", KEY, "phone").startswith("+55 ")
    days = {pii.permute_date(date(1980, 1, 1 + i), KEY) for i in range(31)}
    assert len(days) == 31
    text = "Nome: Valmir Celhares, nascido em 05/03/1980. VALMIR  CELHARES, CPF 529.982.247-25"
    out = pii.redacted(text, pii.Finder(LEXICON).find(text), KEY)
    assert "Valmir" not in out and "05/03/1980" not in out and "529.982" not in out
    marks = [w for w in out.split("[") if w.startswith("name ")]
    assert len(marks) == 2 and marks[0][:13] == marks[1][:13]


def test_lexicon_is_mined_and_nulls_pass(spark):
    rows = [(i, f"Nome: Zulmira Quental\nAutos digitalizados em Pedra Azul\nO Banco paga. Consta isso. Zulmira {i}") for i in range(6)] + [(90, None), (91, "")]
    pages = spark.createDataFrame(rows, "page_id long, text string")
    lexicon = pii.mine_lexicon(pages)
    assert lexicon.names == {"zulmira", "quental"} and lexicon.towns == {"pedra": {("pedra", "azul")}}
    found = pii.found_values(pages, lexicon).groupBy("page_id").count().collect()
    assert {r["page_id"]: r["count"] for r in found} == {i: 2 for i in range(6)}
    out = {r["page_id"]: r["text_out"] for r in pii.redact_pages(pages, lexicon, "s").collect()}
    assert out[90] is None and out[91] == "" and "Zulmira" not in out[0]
    assert pii.found_values(pages.limit(0), pii.mine_lexicon(pages.limit(0))).count() == 0


def test_numbers_keep_their_form_and_never_meet():
    rnd = random.Random(2)
    for kind, size in (("id_number", 11), ("phone", 10), ("phone", 11), ("id_number", 8)):
        values = {"".join(rnd.choice("0123456789") for _ in range(size)) for _ in range(3000)}
        if size == 11 and kind == "id_number":
            values |= {v[:9] + pii.cpf_check(v[:9]) for v in list(values)[:500]} | {v[:10] + pii.pis_check(v[:10]) for v in list(values)[:500]}
        new = {v: pii.permute_number(v, KEY, kind) for v in values}
        assert len(set(new.values())) == len(values)
        assert all(pii.number_form(v, kind) == pii.number_form(n, kind) for v, n in new.items())
    assert pii.permute_number("(71) 98888-0000", KEY, "phone").startswith("(71) 9")


def test_key_is_configured_or_drawn(spark, monkeypatch):
    drawn = queries.pseudonym_key(spark)
    assert len(drawn) == 64 and drawn == queries.pseudonym_key(spark)
    monkeypatch.setenv("RESMA_PSEUDONYM_KEY", "own")
    assert queries.pseudonym_key(spark) == "own"


def test_tags_of_many_values_differ():
    values = [f"n{i}" for i in range(300_000)]
    assert len({pii.redacted(v, [("name", 0, len(v))], b"key") for v in values}) == len(values)


# --- scanned pages

WORDS = {w: 500 for w in "o contratante declara ter recebido cópia integral deste instrumento com reflexos na esfera patrimonial do requerente segundas-feiras as demais moldes".split()}
MODEL = scans.Language(words=WORDS, pairs={("do", "requerente"): 300, ("nos", "moldes"): 50}, total=20_000)


def read(text, number=3, known=(), common=frozenset()):
    return scans.PageReader(MODEL, common).read(text, number, list(known))


@pytest.mark.parametrize("seen", ["requereute", "requer€nte", "rcquerente", "requerentc", "reque.rente", "re9uerente"])
def test_misread_words(seen):
    got = read(f"com reflexos na esfera\npatrimonial do {seen}.")
    assert got.found == [(2, "misread")] and got.paragraphs.endswith("do requerente.")


def test_candidates_are_all_within_three_misreadings():
    import itertools

    words = {w: 10 for w in ("mel", "rnel", "se", "cl", "mim", "clima", "dia", "lim", "nun")}
    speller = scans.Speller(scans.Language(words=words, total=100))

    def brute(seen):
        layer, found = {seen}, set()
        for _ in range(3):
            layer = {w[:i] + m + w[i + n :] for w in layer for i in range(len(w)) for n in (1, 2) for m in scans.CONFUSIONS.get(w[i : i + n], ()) if i + n <= len(w)}
            found |= layer & words.keys()
        return found - {seen}

    for seen in ("".join(x) for n in (2, 3) for x in itertools.product("mcl1irne", repeat=n)):
        got = {w for w, _ in speller.candidates(seen)}
        # what several misreadings of one place after another give is no misreading of the text
        assert got <= brute(seen)
        for w in got:
            ways = speller.ways(seen, w)
            assert 0 < len(ways) <= 3
    assert {w for w, _ in speller.candidates("rne1")} == {"mel", "rnel"} and speller.ways("c1irna", "clima") == [("1", "l"), ("rn", "m")]


def test_channel_is_estimated(spark):
    words = {"mel": 900, "sol": 900, "lua": 900}
    counted = spark.createDataFrame([*words.items(), ("me1", 90), ("so1", 80), ("s0l", 10)], "a string, n long")
    model = scans.Language(words=dict(words), total=2700)
    found = scans.channel(counted, model)
    assert found["1", "l"] > found["0", "o"] > found["|", "l"] and abs(math.exp(found["1", "l"]) - (170 + 4) / (2700 + 2000)) < 1e-9


def test_doubtful_words_give_way_to_strong_evidence():
    model = scans.Language(words={"da": 5000, "conta": 900, "couta": 3, "grande": 50}, pairs={("da", "conta"): 800, ("grande", "couta"): 3}, total=1_000_000, doubtful=frozenset({"couta"}))
    speller = scans.Speller(model)
    assert speller.likeliest(["da", "couta"]) == ["da", "conta"] and speller.likeliest(["grande", "couta"]) == ["grande", "couta"]


def test_unknown_words_are_left():
    for line in ("patrimonial do Zebedeu", "ver AX677 e 12/03/2020 às 8h44", "clovis.quinteral@correio.example", "R$ 12,30"):
        assert read(f"o contratante declara\n{line}").found == []


def test_broken_words():
    got = read("declara ter rece-\nbido cópia inte¬\ngral deste instru-\n\nmento as segundas-\nfeiras - as demais -\nmoldes")
    assert got.found == [(1, "broken_word"), (2, "broken_word"), (3, "broken_word"), (5, "broken_word")]
    assert "recebido" in got.paragraphs and "integral" in got.paragraphs and "segundas-feiras" in got.paragraphs
    # the last word goes on on the next page; the first may have begun on the one before
    assert read("cebido cópia integral deste instru-").found == [(1, "broken_word")]
    # a misread broken word counts where it begins
    assert read("as demais rece-\nbid0 cópia").found == [(1, "broken_word"), (1, "misread")]


def test_furniture():
    head = "Processo nº 1 - Serra Mansa"
    known = [scans.alike(head)]
    got = read(f"{head} Página 3\no contratante declara\n3", 3, known)
    assert got.found == [(1, "furniture"), (3, "furniture")] and got.paragraphs == "o contratante declara"
    assert read("Pr0cesso  nº 1 - Serra Mansa\no contratante", 3, known).found == [(1, "furniture")]
    for mark in ("- 3 -", "[003]", "fls. 3", "Pág. 3 de 9", "3/9", "iii", "fl. 3 __", "Página 3"):
        assert read(f"o contratante declara\n{mark}").found == [(2, "furniture")], mark
    # a value of a table, and a number inside the page, are no page numbers
    assert read("o contratante declara\nmoldes\n43").found == []
    assert read("o contratante\n3\nas demais\ndeclara ter\nrecebido cópia\nintegral\nas demais").found == []
    assert read("\n\n").found == [] and read("\n").paragraphs == ""


def test_pages_tables(spark):
    line = "o contratante declara ter recebido cópia integral deste instrumento com reflexos"
    rows = [(n, "s", n, f"Regulamento do Cartão Azul\n{line}\n{line}\n{line}\n{n}") for n in range(1, 9)] + [(50, "s", 9, None), (51, None, 1, ""), (52, None, 1, line), (53, "t", None, line)]
    pages = spark.createDataFrame(rows, "page_id long, source_sha256 string, page_number int, text string").withColumn("known", F.lit("x"))
    got = {(r["page_id"], r["line_no"], r["kind"]) for r in scans.read_pages(pages, found=True).collect()}
    assert got == {(n, k, "furniture") for n in range(1, 9) for k in (1, 5)}
    out = {r["page_id"]: r["text_out"] for r in scans.read_pages(pages, found=False).collect()}
    assert out[50] is None and out[51] == "" and "Regulamento" not in out[1] and "\n" not in out[1]
    assert scans.read_pages(pages.limit(0), found=True).count() == 0


def test_words_across_pages(spark):
    line = "o contratante declara ter recebido cópia integral deste instrumento com reflexos"
    head = "Regulamento do Cartão Azul"

    def page(first, last, n):
        return f"{head}\n{first}\n{line}\n{line}\n{line}\n{last}\n{n}"

    kinds = "page_id long, source_sha256 string, configuration_sha256 string, page_number int, text string"
    rows = [(n, "s", "c", n, page(line, line, n)) for n in range(1, 7)]
    rows += [(10, "s", "c", 7, page(line, "as demais rece-", 7)), (11, "s", "c", 8, page("bido cópia integral", "deste instru-", 8)), (12, "s", "c", 9, page("mento", "deste instru-", 9))]
    # another configuration, a page that is missing, and one of another source
    rows += [(20, "s", None, 7, page(line, "patrimonial do recebido instru-", 7)), (21, "s", None, 8, page("mento com reflexos", line, 8)), (22, "t", "c", 10, page("mento com reflexos", line, 10))]
    # rows of one page that differ: nothing is carried
    rows += [(30, "s", "d", 1, page(line, "deste instru-", 1)), (31, "s", "d", 2, page("mento com", line, 2)), (32, "s", "d", 2, page("recebido com", line, 2))]
    rows += [(40, None, "c", 1, page(line, "deste instru-", 1)), (41, None, "c", 2, page("mento com", line, 2))]
    out = {r["page_id"]: r["text_out"] for r in scans.read_pages(spark.createDataFrame(rows, kinds), found=False).collect()}
    assert out[10].endswith("as demais recebido") and out[11].startswith("cópia integral") and out[11].endswith("deste instrumento")
    assert out[12].startswith(line) and out[12].endswith("instru-")
    assert out[20].endswith("instrumento") and out[21].startswith("com reflexos") and out[22].find("mento com reflexos") >= 0
    assert out[30].endswith("instru-") and "mento com" in out[31] and "recebido com" in out[32]
    assert out[40].endswith("instru-") or "instru-" in out[40]
    assert "mento com" in out[41]
    # a word misread in its rest is mended whole
    assert scans.PageReader(MODEL).read("as demais rece-", 3, [], rest="bid0").paragraphs == "as demais recebido"


# --- areas


def test_areas_on_held_out_documents(spark):
    rnd = random.Random(4)
    subject = {"sport": ["goleiro", "torcedor", "quadra", "campeonato"], "health": ["cirurgia", "prontuário", "enfermagem", "leito"], "energy": ["medidor", "subestação", "poste", "inversor"]}
    filler = ["os autos foram remetidos ao arquivo", "a citação foi realizada por carta", "as partes elegem o foro"]

    def document(own):
        out = []
        for a in own:
            out += [f"O pedido trata de {rnd.choice(subject[a])} e de {rnd.choice(subject[a])}." for _ in range(2)]
        other = rnd.choice([a for a in subject if a not in own])
        out.append(f"O exemplo de {rnd.choice(subject[other])}, citado pela doutrina, não se aplica.")
        out += [rnd.choice(filler).capitalize() + "." for _ in range(3)]
        rnd.shuffle(out)
        return " ".join(out)

    truth, rows, labels = {}, [], []
    for i in range(700):
        own = rnd.sample(sorted(subject), rnd.choice([0, 1, 1, 2]))
        truth[i] = set(own) or {"procedure"}
        rows.append((i, document(own)))
        if i < 400:
            noisy = set(rnd.sample(sorted(subject), 1)) if rnd.random() < 0.06 else truth[i]
            labels += [(i, a) for a in noisy for _ in range(rnd.choice([1, 1, 2]))]
    docs = spark.createDataFrame([*rows, (9000, None), (9001, "")], "doc_id long, text string").withColumn("area", F.lit("x"))
    rules = areas.mine(areas.labelled_sample(docs, spark.createDataFrame(labels, "doc_id long, area string")))
    got = {}
    for r in areas.assign(docs, rules).collect():
        got.setdefault(r["doc_id"], set()).add(r["area"])
    held_out = [got[i] == truth[i] for i in range(400, 700)]
    assert sum(held_out) / len(held_out) > 0.93
    assert got[9000] == got[9001] == {"procedure"} and len(got) == 702
    parts = {r["area"]: r["document_share"] for r in areas.composition(areas.assign(docs.withColumn("n_chars", F.length("text")), rules, keep=("n_chars",))).collect()}
    assert abs(sum(parts.values()) - 1) < 1e-9


def test_prune_and_empty_labels(spark):
    kept = areas.prune([(frozenset({"a", "b"}), "x", 0.9), (frozenset({"a"}), "x", 0.9), (frozenset({"c", "b"}), "x", 0.95), (frozenset({"b"}), "x", 0.6)])
    assert [k for k, _, _ in kept] == [frozenset({"a"}), frozenset({"b"}), frozenset({"b", "c"})]
    docs = spark.createDataFrame([(1, "texto")], "doc_id long, text string")
    rules = areas.mine(areas.labelled_sample(docs, spark.createDataFrame([], "doc_id long, area string")))
    assert [r["area"] for r in areas.assign(docs, rules).collect()] == ["procedure"]


@pytest.mark.parametrize("budget", [None, 60_000])
def test_mix_keeps_buckets_even(spark, monkeypatch, budget):
    """Shares of 99 to 1 against stocks of 1 to 99: no bucket of time or order holds much of the rows, and what is served is what one queue serves."""
    held = []
    plain = mixing.running_total

    def watched(rows, groups, bucket, order, amount, out):
        n = [r["count"] for r in rows.groupBy(*groups, bucket).count().collect()]
        held.append(max(n) / sum(n))
        return plain(rows, groups, bucket, order, amount, out)

    monkeypatch.setattr(mixing, "running_total", watched)
    docs = [(i, "small" if i < 40 else "large", 20 + i % 7) for i in range(4000)]
    sized = spark.createDataFrame(docs, "doc_id long, source string, n_tokens int")
    targets = spark.createDataFrame([("small", 0.99, 3), ("large", 0.01, 2)], "source string, target_share double, max_repeats int")
    got = {r["doc_id"]: r["repeats"] for r in mixing.mix(sized, targets, budget=budget, rows=10)[0].collect()}
    assert max(held) < 1 / 16
    order = {r["doc_id"]: r["h"] for r in sized.select("doc_id", F.xxhash64(F.lit(17), F.col("doc_id")).alias("h")).collect()}
    queue, stock = [], {s: sum(t for _, x, t in docs if x == s) for s in ("small", "large")}
    for s, w, cap in (("small", 0.99, 3), ("large", 0.01, 2)):
        own = sorted((d for d in docs if d[1] == s), key=lambda d: (order[d[0]], d[0]))
        for k in range(cap):
            run = 0
            for d in own:
                run += d[2]
                queue.append(((k * stock[s] + run) / w, s, d[0], k, d[2]))
    total = budget or min(stock["small"] * 3 / 0.99, stock["large"] * 2 / 0.01)
    want, served = {}, 0
    for _, _, i, _, t in sorted(queue):
        served += t
        if served > total:
            break
        want[i] = want.get(i, 0) + 1
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab. ;!?\n1,_é", max_size=40))
def test_items_of_a_text_are_those_of_its_sentences(text):
    each = [x for x in map(areas.items_of, areas.sentences(text)) if x]
    assert areas.items_of(text) == set().union(*each) and areas.items_by_sentence(text) == each


def _bags(spark):
    rnd = random.Random(8)
    rows = [(0, ["x"], ["x"], []), (1, ["y"], ["x"], [[]])]
    for i in range(2, 60):
        bag = [sorted(rnd.sample(range(29), rnd.randint(0, 12))) for _ in range(rnd.randint(1, 6))]
        rows.append((i, rnd.sample(["x", "y", "z", areas.REST], rnd.randint(1, 3)), rnd.sample(["x", "y", "z"], rnd.randint(0, 2)), [*bag, *bag[:1]]))
    # word 13 leans to y, 29 stands beside it where the document is not about y
    rows += [(i, ["x"], ["z"], [[13, 22, 29], [29]]) for i in range(60, 66)] + [(66, ["x"], ["y"], [[13, 29]])]
    return rows, spark.createDataFrame(rows, "doc_id long, areas array<string>, given array<string>, bags array<array<int>>").repartition(3)


def test_sample_of_areas_is_counted_once(spark):
    """The counts of all documents and of each area come from one reading of the sample."""
    rows, bags = _bags(spark)
    read, names = spark.sparkContext.accumulator(0), [f"w{i}" for i in range(30)]

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counts = areas.item_counts(bags.mapInArrow(counted, bags.schema))
    got = areas.leaning_items(counts, names, least=2, lean=0.1)
    assert read.value == len(rows)
    docs = {i: [r for r in rows if any(i in s for s in r[3])] for i in range(30)}
    want = {}
    for i, own in docs.items():
        n, area = max((sum(a in r[1] for r in own), a) for a in ("x", "y", "z"))
        if n >= 2 and areas.lower_bound(n, len(own)) >= 0.1:
            want[i] = (area, (n + 0.5) / (len(own) + 1))
    assert want and got == want


def test_contexts_and_transactions_of_areas(spark):
    """Counting on flat numbers gives what a walk over each sentence gives."""
    rows, bags = _bags(spark)
    leaning = {i: ("xyz"[i % 3], 0.6 + i / 40) for i in range(14)}
    f, n, want = Counter(), Counter(), Counter()
    context = {20: 0.9, 21: 0.8, 22: 0.9}
    for _, own, labelled, bag in rows:
        about, seen = {*own, *labelled}, {True: set(), False: set()}
        for s in bag:
            named = {leaning[i][0] for i in s if i in leaning and leaning[i][1] >= 0.75}
            if named:
                seen[named.isdisjoint(about)].update(i for i in s if i not in leaning)
        f.update(seen[True])
        n.update([*seen[True], *seen[False]])
        for s in {tuple(s) for s in bag}:
            lean = sorted((i for i in s if i in leaning), key=lambda i: -leaning[i][1])
            near = sorted((i for i in s if i in context), key=lambda i: (-context[i], i))
            named = {leaning[i][0] for i in lean if leaning[i][1] >= 0.75}
            told = (["=foreign"] if named and named.isdisjoint(about) else []) if near else ["=" + a for a in own if a != areas.REST]
            for k in range(0, len(near or lean) if lean else 0, areas.PART):
                want[(*map(str, (near or lean)[k : k + areas.PART]), *told)] += 1
    share = {i: f[i] / n[i] for i in n if f[i] >= 2 and f[i] > 0.6 * n[i]}
    assert share[29] == 6 / 7 and areas.foreign_items(bags, leaning, 30, least=2) == share
    got = Counter(tuple(r["items"]) for r in areas.transactions(bags, leaning, context, 30).collect())
    assert want and got == want
    assert not areas.transactions(bags, {}, {}, 30).count() and not areas.foreign_items(bags, {}, 30)
