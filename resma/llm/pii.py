"""Personal values in free text: found, typed, and replaced by linked pseudonyms.

Numbers, mail and street addresses are told by their forms and labels. Names are told by a
lexicon of name words and of towns that is counted over the whole corpus at places which hold
nothing else ("Nome:", signature lines, "Autos digitalizados em"), and by these places
themselves. Company data is set apart first. Numbers keep their format: their digits go
through a keyed Feistel permutation, so equal values have equal pseudonyms in all documents.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resma.plans.cut import cut

UP, LOW = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
GAP = r"(?: {1,3}|\s?\n)"  # within a value: spaces or one line end
WORD = rf"(?:[{UP}][{LOW}]+(?:['’-][{UP}{LOW}]+)*|[{UP}]{{2,}}(?:['’-][{UP}]+)*)"
INITIAL = rf"(?:(?<![\w.])[{UP}]\.(?=\s))"
PARTICLE = r"(?:d[aeo]s?|e|D[AEO]S?|E)"
SEQUENCE = rf"(?:{WORD}|{INITIAL})(?:{GAP}(?:{PARTICLE}{GAP})?(?:{WORD}|{INITIAL}))*"

# Words that head or end company names.
COMPANY_END = r"(?:S\.?\s?/?A\.?|Ltda\.?|LTDA\.?|EIRELI|Eireli|ME|EPP|S/C)"
COMPANY_HEAD = r"(?:Banco|Financeira|Construtora|Cooperativa|Faculdade|Universidade|Via[çc][ãa]o|Irm[ãa]os|Hospital|Cl[íi]nica|Associa[çc][ãa]o|Instituto|Companhia|Editora|Transportadora|Operadora|Incorporadora|Seguradora|Distribuidora|Col[ée]gio|Escola|Lojas?|Grupo|Supermercados?|Funda[çc][ãa]o|Condom[íi]nio)"
# Kinds of streets and places with which addresses begin.
STREET = r"(?:Rua|R\.|Avenida|Av\.?|Travessa|Trav\.|Tv\.|Pra[çc]a|P[çc]a?\.|Alameda|Al\.|Estrada|Estr?\.|Ladeira|Lad\.|Rodovia|Rod\.|Largo|Lgo\.|Beco|Viela|Via|S[íi]tio|Fazenda|Faz\.|Ch[áa]cara|Loteamento|Lot\.|Conjunto|Conj\.|Povoado|Pov\.|Distrito|Assentamento|Residencial|Condom[íi]nio|Vila|Jardim|Parque|Quadra)"
STREET_ANY = rf"(?:{STREET}|(?:{STREET.upper().replace('[ÇC]', '[ÇC]')}))"
OWNED = re.compile(rf"(?:sedes?|balc[ãa]o|loja|ag[êe]ncia|filial|posto|escrit[óo]rio|matriz|guich[êe])(?:{GAP}(?:situad|localizad|estabelecid)[oa])?{GAP}(?:na|no|em|à|ao|nas|nos){GAP}$|(?:sedes?|balc[ãa]o|filial|matriz):{GAP}$", re.I)

_number = r"(?:n[.ºo°]*\s?)?(?:\d{1,5}(?:-[A-Z])?(?!\d)|s/n[º°]?)"
ADDRESS = re.compile(
    rf"(?<![\w.]){STREET_ANY}{GAP}"
    rf"(?:[{UP}\d][\w'’ªº]*\.?|{PARTICLE})(?:{GAP}(?!CEP\b|n\.|nº|s/n)(?:[{UP}\d][\w'’ªº]*\.?|{PARTICLE})){{0,6}}?"
    rf"(?:,?{GAP}{_number}|,{GAP}(?:Quadra|Qd\.?|Lote|Km|km|KM){GAP}?\d+|,?{GAP}CEP)"
    rf"(?:,?{GAP}(?:apto\.?|ap\.|casa|bloco|bl\.|sala|lote|quadra|fundos|Quadra|Lote|Bloco|Casa|Apto\.?|km|Km){GAP}?[\w/-]{{0,6}}|,{GAP}zona{GAP}(?:rural|urbana)|,{GAP}s/n)*"
)
ADDRESS_TAIL = re.compile(rf"(?:,?{GAP}(?:(?:bairro|Bairro|Centro|distrito){GAP}?)?(?:{WORD}(?:{GAP}(?:{PARTICLE}{GAP})?{WORD})*))?(?:/[A-Z]{{2}})?(?:,?{GAP}(?:CEP|Cep):?{GAP}\d{{2}}\.?\d{{3}}-?\d{{3}})?")
CEP_TAIL = re.compile(rf"(?:,{GAP}(?:{WORD}(?:{GAP}(?:{PARTICLE}{GAP}|d['’])?{WORD})*))?,?{GAP}(?:CEP|Cep):?{GAP}\d{{2}}\.?\d{{3}}-?\d{{3}}")

_at = r"(?:{s}?@{s}?|{s}?[(\[{{<](?:arroba|at|a)[)\]}}>]{s}?|{s}arroba{s})".format(s=r"[ \n]")
_dot = r"(?:\.|[ \n]?[(\[](?:ponto|dot)[)\]][ \n]?|[ \n]ponto[ \n]|[ \n]\.[ \n]?)"
EMAIL = re.compile(rf"(?<![\w.+-])[A-Za-z0-9][\w+-]*(?:(?:\.|[ ](?:ponto|sublinhado|underline)[ ])[\w+-]+)*{_at}[A-Za-z0-9]+(?:-\n?[A-Za-z0-9]+)*(?:{_dot}[A-Za-z0-9]+(?:-[A-Za-z0-9]+)*)+", re.I)
SPELT_SIGN = re.compile(r"[(\[{<](?:arroba|at|a)[)\]}>]|[ \n]arroba[ \n]", re.I)
# The longest name and domain that mail allows (64 and 255 characters), and half as much again for spelt dots.
LOCAL, DOMAIN = 96, 384
# Mail boxes of offices, not of persons.
OFFICE_BOX = re.compile(r"(?:ouvidoria|sac|contato|atendimento|faleconosco|fale\.conosco|vendas|juridico|comercial|financeiro|suporte|secretaria|cartorio|vara|rh|info|cobranca|central)\b", re.I)

_sep = r"[ .\n-]?"
PHONE = re.compile(
    r"(?<![\w./-])(?:"
    r"(?:\+\s?55[ \n]?)?\(0?\d{2}\)[ \n]{0,2}\d{4,5}[ .\n-]?\d{4}"
    r"|\+\s?55[ \n]?\d{2}[ \n]?\d{4,5}[ .\n-]?\d{4}"
    r"|0\d{2}[ \n]\d{4,5}[ \n.-]\d{4}"
    r"|55\d{2}9?\d{8}"
    r"|\d{2}[ \n]9?\d{8}"
    r"|\d{2}[ \n]9?\d{4}[.-]\d{4}"
    r")(?![\d/]|[.-]\d)"
)
PHONE_BEFORE = re.compile(rf"(?:tel(?:efone)?s?|fones?|cel(?:ular)?|contato|whats(?:app)?|zap|ligar|chamada)\.?:?{GAP}(?:(?:de|para|no|n[º°o]\.?|número|celular){GAP})*$", re.I)
PLAIN_PHONE = re.compile(r"\(?\d[\d().-]*(?:[ \n][\d().-]+){0,3}")
#: digits with what may stand between them: what may be a number of a person
NUMBER = re.compile(r"\d[\d .()/\n-]{5,}[\dXx]")
DIGITS = re.compile(r"\d+")
COMPANY_PHONE = re.compile(rf"(?:Ouvidoria|SAC|Central{GAP}de|Atendimento|Televendas|PABX|Plant[ãa]o{GAP}da)[^.;\n]{{0,20}}(?:\n?[^.;\n]{{0,60}}(?:S\.A\.)?[^.;\n]{{0,10}}):?{GAP}$|{COMPANY_END}:?{GAP}$", re.I)

ID_LABEL = (
    r"(?:C\.?P\.?F\.?(?:/MF)?|R\.?G\.?|(?:carteira{g}de{g})?identidade|PIS(?:/PASEP)?|PASEP|NIS|NIT|CNH|CTPS|RNE|NB|t[íi]tulo{g}(?:de{g})?eleitor(?:al)?|"
    r"benef[íi]cio|cadastro{g}de{g}pessoas(?:{g}f[íi]sicas)?|inscri(?:t[oa]|ç[ãa]o)|habilita[çc][ãa]o|seguridade|passaporte|INSS)"
).format(g=GAP)
ID_BEFORE = re.compile(rf"(?<!\w)(?:{ID_LABEL}[:.]?{GAP}(?:sob{GAP})?(?:o{GAP})?(?:(?:n[.ºo°]*|número|RG|CPF|registro){GAP})?(?:[:-]{GAP})?|sob{GAP}(?:o{GAP})?(?:n[.ºo°]*|número){GAP})$", re.I)
PLAIN_ID = re.compile(r"\d{5,12}(?:-[\dXx])?(?![\d])")
FORMED_ID = re.compile(
    r"(?<![\d./-])(?:\d{3}\.\d{3}\.\d{3}[-/]\d{2}|\d{9}[-/]\d{2}|\d{3}[ \n]\d{3}[ \n]\d{3}[ \n-]\d{2}|\d{3}\.\d{3}\.\d{3}-\d|\d{3}\.\d{5}\.\d{2}-\d|\d{2}\.\d{3}\.\d{3}(?:-[\dXx])?|\d{8}-[\dXx]|\d{4}[ \n]\d{4}[ \n]\d{4}|(?<=[^\W\d_][ \n]/[ \n])\d{11})(?![\d/]|[.-]\d)"
)
# Labels of numbers that are no one's identity.
NOT_PERSONAL = re.compile(rf"(?:CNPJ(?:/MF)?|Protocolo|Proposta|Processo|autos|valida[çc][ãa]o|CEP|Ouvidoria|0800|contrato|R\$|c[óo]digo|fls?\.|NIRE|S\.A\.|Ltda){GAP}?(?:(?:n[.ºo°]*|número|sob|o|-|:){GAP}?)*$", re.I)

TITLE = r"(?:Sr|Sra|Srta|Dr|Dra|Doutora?|Senhora?|Dona|Seu|Prof|Profa|Professora?)"
# Words after which a person's name follows, as they begin and as they go on.
NAME_KEYS = ["Nome", "NOME", "Titular", "Testemunha", "Sr", "Dr", "Dout", "Senhor", "Dona ", "Seu ", "Prof", "_ ", "_\n", "Intime", "nome", "filho", "filha", "titularidade", "assina", "deixado", "procurar", "poderes", "devidos", "procurador", "advogad", "depoimento", "balcão"]
NAME_BEFORE = (
    rf"Nome(?:{GAP}completo)?{GAP}?[:-]?{GAP}|NOME(?:{GAP}COMPLETO)?:?{GAP}|Titular{GAP}?[:-]{GAP}|Testemunhas?{GAP}?:{GAP}|(?<![\w.]){TITLE}\.?(?:\([aA]\)\.?)?{GAP}|(?<=____)_{GAP}|"
    rf"Intimem?-se{GAP}|nome{GAP}de{GAP}|filh[oa]{GAP}de{GAP}|titularidade{GAP}de{GAP}|assina{GAP}é{GAP}|deixado{GAP}por{GAP}|procurar{GAP}|poderes{GAP}a{GAP}|devidos{GAP}fins{GAP}que{GAP}|(?:procurador|advogad[oa]|procuradora|depoimento{GAP}de),?{GAP}|balcão,{GAP}"
)
BEFORE = re.compile(rf"(?:{NAME_BEFORE})({SEQUENCE})")
# Words after which a town follows.
TOWN_KEYS = ["digitalizados", "cidade", "unidade", "ligou", "Comarca", "| "]
TOWN_BEFORE = rf"(?:digitalizados{GAP}em{GAP}|cidade{GAP}de{GAP}|unidade{GAP}de{GAP}|ligou{GAP}de{GAP}|Comarca{GAP}de{GAP}|\|{GAP})"
TOWN = re.compile(rf"{TOWN_BEFORE}({WORD}(?: (?:{PARTICLE} |d['’])?{WORD}){{0,3}})")
_firm = rf"[{UP}][\w'’@|!~^-]*"  # misread characters are allowed in it
COMPANY = re.compile(rf"(?:{_firm}(?:[ .]{{1,3}}(?:(?:{PARTICLE}|&) )?{_firm}){{0,5}}{GAP}{COMPANY_END}(?!\w))|(?<!\w){COMPANY_HEAD}(?:{GAP}(?:{PARTICLE}{GAP}|&{GAP})?{WORD}){{1,4}}")
CAPITAL = re.compile(rf"\b{WORD}(?!\w)")
LEAD = re.compile(rf"(?:{INITIAL}{GAP}){{1,3}}$")
BETWEEN = re.compile(GAP)

# Capitalised words that are never part of a name.
NEVER = frozenset(
    "rg cpf cnh pis cep cnpj nis nit ctps uf mf cód código nome titular testemunha celular fone tel telefone contato endereço end e-mail email correio documento identidade benefício sr sra dr dra senhor senhora doutor doutora professora professor "
    "juiz juíza vara juizado tribunal poder judiciário processo autos comarca página pág fls fl consta conta recado mensagem declaro intimem-se intime-se no na nos nas em ao aos à às o a os as um uma de da do das dos e por para com sem que se não "
    "cláusula contrato parcela valor total data item lote quadra capítulo artigo dados qualificação identificação cliente aderente pessoais bairro cidade estado federal brasil bahia ouvidoria central vendas protocolo proposta "
    "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro".split()
)

#: Fewest places at which a word must stand as a name, and least share of all its places.
LEAST_PLACES = 3
LEAST_SHARE = 0.08
#: Least share of all places of names (of towns) that a word of the lexicon has: there are at most 1 / share of either, whatever the corpus.
PLACE_SHARE = 1e-6

KINDS = ("email", "phone", "id_number", "address", "name")


def fold(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", word.casefold()) if not unicodedata.combining(c))


@dataclass
class Lexicon:
    names: set[str] = field(default_factory=set)
    #: towns as tuples of folded words, by their first word
    towns: dict[str, set[tuple[str, ...]]] = field(default_factory=dict)


def words_of(text: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", text)]


def automaton(keys: list[str]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for k in keys:
        a.add_word(k, len(k) - 1)
    a.make_automaton()
    return a


def keyed(pattern: re.Pattern[str], keys, text: str) -> Iterator[re.Match[str]]:
    """Matches of ``pattern`` that begin at a key; the keys are found in one pass."""
    match, last = pattern.match, -1
    for end, back in keys.iter(text):
        if end - back > last and (m := match(text, end - back)):
            last = end - back
            yield m


def lexicon_counts(pages: DataFrame, text: str = "text") -> DataFrame:
    """(kind, word, n) over all pages: words at name places, all capitalised words, towns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, towns = automaton(NAME_KEYS), automaton(TOWN_KEYS)
        for batch in batches:
            counts: Counter[tuple[str, str]] = Counter()
            capitals: Counter[str] = Counter()
            for t in batch.column(0).to_pylist():
                if not t:
                    continue
                capitals.update(map(str.lower, CAPITAL.findall(t)))
                for m in keyed(BEFORE, names, t):
                    counts.update(("name", w) for w in words_of(m.group(1)) if len(w) > 2)
                for m in keyed(TOWN, towns, t):
                    counts["town", " ".join(words_of(m.group(1)))] += 1
            counts.update({("all", w): n for w, n in capitals.items()})
            keys = list(counts)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([counts[k] for k in keys], pa.int64())], names=["kind", "word", "n"])

    return pages.select(text).mapInArrow(run, "kind string, word string, n long").groupBy("kind", "word").agg(F.sum("n").alias("n"))


def mine_lexicon(pages: DataFrame, text: str = "text") -> Lexicon:
    """The lexicon of a corpus, counted over all its pages."""
    wide = cut(lexicon_counts(pages, text).groupBy("word").agg(*[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k) for k in ("name", "all", "town")]))
    places = wide.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("name", "town")]).collect()[0]  # one row
    least = {k: max(LEAST_PLACES, PLACE_SHARE * places[k]) for k in ("name", "town")}
    names = wide.where((F.col("name") >= least["name"]) & (F.col("name") >= LEAST_SHARE * F.col("all"))).select("word").collect()
    towns = wide.where(F.col("town") >= least["town"]).select("word", F.col("town").alias("n")).collect()
    out = Lexicon(names={r["word"] for r in names} - NEVER)
    often = {tuple(r["word"].split()): r["n"] for r in towns}
    for parts, n in often.items():
        # a town with more words after it, or cut short, is found less often than the town
        if any(often.get(parts[:k], 0) >= n for k in range(2, len(parts))) or (len(parts) == 1 and any(len(t) > 1 and t[0] == parts[0] and m >= n for t, m in often.items())):
            continue
        if parts and (len(parts) > 1 or parts[0] not in out.names):
            out.towns.setdefault(parts[0], set()).add(parts)
    return out


class Finder:
    """Finds the personal values of texts."""

    TOKEN = re.compile(rf"{WORD}|{INITIAL}|(?<!\w){PARTICLE}(?!\w)")

    def __init__(self, lexicon: Lexicon) -> None:
        self.names, self.towns = lexicon.names, lexicon.towns
        # a town may be parted by a few spaces and line ends
        self.longest = 8 + max((2 * len(t) + sum(map(len, t)) for ts in lexicon.towns.values() for t in ts), default=0)
        self.keys = automaton(NAME_KEYS)

    def find(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in order of start; spans do not overlap."""
        taken = bytearray(len(text))
        found: list[tuple[str, int, int]] = []

        def take(kind: str | None, start: int, end: int) -> None:
            taken[start:end] = b"\x01" * (end - start)
            if kind:
                found.append((kind, start, end))

        def free(start: int, end: int) -> bool:
            return taken.find(1, start, end) < 0

        at = -1
        while (at := text.find("@", at + 1)) >= 0:
            if (m := next((m for m in EMAIL.finditer(text, max(0, at - LOCAL), at + DOMAIN) if m.start() < at < m.end()), None)) and free(*m.span()):
                take(None if OFFICE_BOX.match(m.group()) else "email", m.start(), m.end())
        for s in SPELT_SIGN.finditer(text):
            if (m := next((m for m in EMAIL.finditer(text, max(0, s.start() - LOCAL), s.end() + DOMAIN) if m.start() < s.start() < m.end()), None)) and free(*m.span()):
                take(None if OFFICE_BOX.match(m.group()) else "email", m.start(), m.end())
        for m in ADDRESS.finditer(text):
            start, end = m.span()
            if not free(start, end):
                continue
            if tail := CEP_TAIL.match(text, end):
                end = tail.end()
            elif tail := ADDRESS_TAIL.match(text, end):
                end = self.town_end(text, end, tail.end())
            take(None if OWNED.search(text, max(0, start - 40), start) else "address", start, end)
        for number in NUMBER.finditer(text):
            at, stop = number.span()
            while at < stop and (d := DIGITS.search(text, at, stop)):
                at = d.end()
                if not free(d.start(), at) or (d.start() and text[d.start() - 1] in "./-" and text[d.start() - 2 : d.start() - 1].isdigit()):
                    continue
                if found_number := self.number_at(text, d.start()):
                    kind, start, end = found_number
                    if free(start, end):
                        take(kind, start, end)
                        at = end
        for m in COMPANY.finditer(text):
            if free(*m.span()):
                take(None, *m.span())
        self.find_names(text, free, take)
        found.sort(key=lambda x: x[1])
        return found

    def number_at(self, text: str, at: int) -> tuple[str | None, int, int] | None:
        """The number of a person, or of no person (None), that begins at digit ``at``."""
        low = max(0, at - 45)
        formed = FORMED_ID.match(text, at)
        labelled = ID_BEFORE.search(text, low, at)
        if formed or labelled:
            m = formed or PLAIN_ID.match(text, at)
            if m:
                label_at = labelled.start() if labelled else at
                other = NOT_PERSONAL.search(text, max(0, label_at - 30), label_at)
                return (None if other else "id_number"), m.start(), m.end()
        lead = at
        if lead and text[lead - 1] == "(":
            lead -= 1
        plus = text[max(0, lead - 5) : lead]
        if plus.rstrip(" \n").endswith("+55"):
            lead -= len(plus) - plus.rindex("+")
        elif lead and text[lead - 1] == "+":
            lead -= 1
        m = PHONE.match(text, lead) or PHONE.match(text, at)
        if not m and PHONE_BEFORE.search(text, low, at):
            m = PLAIN_PHONE.match(text, at)
        if not m or not 8 <= sum(map(str.isdigit, m.group())) <= 13 or text.startswith(("0800", "0300", "0500", "4004"), m.start()):
            return None
        before = text[max(0, m.start() - 90) : m.start()]
        return (None if COMPANY_PHONE.search(before) or NOT_PERSONAL.search(before[-30:]) else "phone"), m.start(), m.end()

    def town_end(self, text: str, start: int, stop: int) -> int:
        """Where the town that follows an address ends, or ``start`` if none does."""
        words = list(re.finditer(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", text[start:stop]))
        parts = tuple(m.group().lower() for m in words)
        fit = max((len(t) for t in self.towns.get(parts[0], ()) if parts[: len(t)] == t), default=0) if parts else 0
        return start + words[fit - 1].end() if fit else start

    def find_names(self, text: str, free, take) -> None:
        anchors = {m.start(1) for m in keyed(BEFORE, self.keys, text)}
        names, towns = self.names, self.towns
        done = 0
        seeds = [(m.start(), m.end()) for m in CAPITAL.finditer(text) if (w := m.group().lower()) in names or w in towns]
        for a in anchors:
            seeds.append((a, a))
        for start, end in sorted(seeds):
            if start < done:
                continue
            word = text[start:end].lower()
            if word in towns and (stop := self.town_end(text, start, start + self.longest)) > end:
                done = stop
                continue
            anchored = start == end
            if not anchored and (word not in names or word in NEVER):
                continue
            # initials before the first word belong to the name
            if not anchored and (lead := LEAD.search(text, max(done, start - 12), start)):
                start = lead.start()
            stop = self.name_end(text, start, anchored or start in anchors)
            if stop > start and free(start, stop):
                take("name", start, stop)
                done = stop

    def name_end(self, text: str, start: int, anchored: bool) -> int:
        """Where the name that begins at ``start`` ends: words of the lexicon and initials,
        joined by particles; at a place for names also other capitalised words of the line."""
        at, stop, last = start, start, -1
        while m := self.TOKEN.match(text, at):
            word, low = m.group(), m.group().lower()
            if word[-1] == ".":
                stop = m.end() if stop > start or anchored or last >= 0 or at == start else stop
            elif low in ("da", "de", "do", "das", "dos"):
                if at == start:
                    break
            elif low in NEVER:
                break
            elif low in self.names or (anchored and len(word) > 2 and "\n" not in text[max(start, at - 1) : at]):
                stop = m.end()
                last = at
            else:
                break
            gap = BETWEEN.match(text, m.end())
            if not gap:
                break
            at = gap.end()
        return stop if last >= 0 else start


# --- pseudonyms


def _mix(half: str, key: bytes, tweak: bytes, r: int, n: int) -> int:
    return int.from_bytes(hashlib.blake2b(half.encode() + tweak, key=key, person=bytes([r, n]), digest_size=16).digest(), "big")


def feistel(digits: str, key: bytes, tweak: bytes = b"", rounds: int = 10) -> str:
    """A keyed permutation of the digit strings of one length (an alternating Feistel network
    of an even number of rounds; one digit is shifted)."""
    n = len(digits)
    if n < 2:
        return str((int(digits) + _mix("", key, tweak, 0, n)) % 10) if digits else digits
    a, b = digits[: n // 2], digits[n // 2 :]
    for r in range(rounds):
        width = len(a)
        a, b = b, f"{(int(a) + _mix(b, key, tweak, r, n)) % 10**width:0{width}d}"
    return a + b


def unfeistel(digits: str, key: bytes, tweak: bytes = b"", rounds: int = 10) -> str:
    """The inverse of ``feistel``."""
    n = len(digits)
    if n < 2:
        return str((int(digits) - _mix("", key, tweak, 0, n)) % 10) if digits else digits
    a, b = digits[: n // 2], digits[n // 2 :]
    for r in reversed(range(rounds)):
        width = len(b)
        a, b = f"{(int(b) - _mix(a, key, tweak, r, n)) % 10**width:0{width}d}", a
    return a + b


def cpf_check(base: str) -> str:
    for w in (10, 11):
        base += str(sum(int(c) * (w - i) for i, c in enumerate(base)) * 10 % 11 % 10)
    return base[-2:]


def pis_check(base: str) -> str:
    """The check digit of the first ten digits of a social-security number."""
    rest = 11 - sum(int(c) * w for c, w in zip(base, (3, 2, 9, 8, 7, 6, 5, 4, 3, 2))) % 11
    return str(rest) if rest < 10 else "0"


def phone_prefix(digits: str) -> int:
    """How many leading digits of a valid number of this length are area and kind of line: they
    are kept, so that the pseudonym is a number of the same kind; 0 if the number has no valid form."""
    area = digits[0] != "0" and digits[1] != "0" if len(digits) > 1 else False
    if len(digits) == 11 and area and digits[2] == "9":
        return 3
    return 2 if len(digits) == 10 and area and digits[2] in "2345" else 0


def number_form(digits: str, kind: str) -> str:
    """The valid form of a number: ``cpf`` and ``pis`` with right check digits, ``mobile`` and ``fixed`` lines with their area, else ''."""
    if kind == "id_number" and len(digits) == 11:
        return "cpf" if cpf_check(digits[:9]) == digits[9:] else "pis" if pis_check(digits[:10]) == digits[10] else ""
    if kind == "phone":
        return {3: "mobile", 2: "fixed", 0: ""}[phone_prefix(digits)]
    return ""


def permute_digits(digits: str, key: bytes, kind: str, form: str) -> str:
    """One step of the permutation of numbers of ``form``."""
    if form == "cpf":
        base = feistel(digits[:9], key, b"id_number")
        return base + cpf_check(base)
    if form == "pis":
        base = feistel(digits[:10], key, b"pis")
        return base + pis_check(base)
    kept = {"mobile": 3, "fixed": 2}.get(form, 0)
    return digits[:kept] + feistel(digits[kept:], key, kind.encode() + digits[:kept].encode())


def permute_number(value: str, key: bytes, kind: str) -> str:
    """``value`` with its digits permuted and all else kept, after its form has been validated: a
    tax or social-security number with right check digits becomes another with right ones, a
    mobile or fixed line another of its area, a number of no valid form another of none. Steps
    are repeated until the form is that of the value, so different numbers never meet."""
    if kind == "phone" and value.startswith("+55"):
        return "+55" + permute_number(value[3:], key, kind)  # the country is no secret
    digits = "".join(c for c in value if c.isascii() and c.isdigit())
    form = number_form(digits, kind)
    new = permute_digits(digits, key, kind, form)
    while number_form(new, kind) != form:
        new = permute_digits(new, key, kind, form)
    it = iter(new)
    return "".join(next(it) if c.isascii() and c.isdigit() else c for c in value)


FIRST_DAY, DAYS = date(1900, 1, 1), 73_049  # to 2099-12-31


def permute_date(day: date, key: bytes) -> date:
    """A keyed permutation of the days of 1900 to 2099 (cycle walking); other days are kept."""
    n = (day - FIRST_DAY).days
    if not 0 <= n < DAYS:
        return day
    while True:
        n = int(feistel(f"{n:05d}", key, b"date"))
        if n < DAYS:
            return FIRST_DAY + timedelta(days=n)


BIRTH = re.compile(r"(?:nascid[oa](?:\s+na\s+cidade\s+de\s+[^,\d]{2,40})?,?\s+(?:em|aos)\s+|nascimento:?\s+)(\d{2})/(\d{2})/(\d{4})", re.I)


def redacted(text: str, spans: list[tuple[str, int, int]], key: bytes) -> str:
    """``text`` with each value as a typed placeholder, such as [phone (71) 98888-0000] with
    permuted digits or [name 3f9a2c51b07de8463f9a2c51b07de846]; birth dates are permuted in place."""
    out, at = [], 0
    for kind, start, end in spans:
        out.append(text[at:start])
        value = text[start:end]
        flat = " ".join(value.split())
        if kind in ("phone", "id_number"):
            out.append(f"[{kind} {permute_number(flat, key, kind)}]")
        else:
            out.append(f"[{kind} {hashlib.blake2b(fold(flat).encode(), key=key, digest_size=16).hexdigest()}]")
        at = end
    out.append(text[at:])

    def birth(m: re.Match) -> str:
        try:
            day = permute_date(date(int(m[3]), int(m[2]), int(m[1])), key)
        except ValueError:
            return m[0]
        return m[0][: m.start(1) - m.start()] + day.strftime("%d/%m/%Y")

    return BIRTH.sub(birth, "".join(out))


def found_values(pages: DataFrame, lexicon: Lexicon, key: str = "page_id", text: str = "text") -> DataFrame:
    """(key, kind, start_pos, end_pos): one row per value, positions in characters from 1, the
    end inclusive. Null and empty texts have none; repeated pages are told alike."""
    sent = pages.sparkSession.sparkContext.broadcast(lexicon)  # at most 1 / PLACE_SHARE words of either kind
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(sent.value)
        for batch in batches:
            at, kinds, starts, ends = [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                for k, s, e in finder.find(t) if t else ():
                    at.append(i)
                    kinds.append(k)
                    starts.append(s + 1)
                    ends.append(e)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=[key, "kind", "start_pos", "end_pos"])

    return pages.select(key, text).mapInArrow(run, f"`{key}` {kind}, kind string, start_pos long, end_pos long")


def redact_pages(pages: DataFrame, lexicon: Lexicon, secret: str, key: str = "page_id", text: str = "text") -> DataFrame:
    """(key, text_out, values): the texts with placeholders and the number of values replaced;
    a null text stays null."""
    sent = pages.sparkSession.sparkContext.broadcast(lexicon)
    kind = pages.schema[key].dataType.simpleString()
    secret_key = hashlib.blake2b(secret.encode(), digest_size=32).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(sent.value)
        for batch in batches:
            out, n = [], []
            for t in batch.column(1).to_pylist():
                spans = finder.find(t) if t else []
                out.append(redacted(t, spans, secret_key) if t is not None else None)
                n.append(len(spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(n, pa.int32())], names=[key, "text_out", "values"])

    return pages.select(key, text).mapInArrow(run, f"`{key}` {kind}, text_out string, values int")
