"""How names sound: double metaphone as a table of patterns, run in Arrow batches once for each different text."""

from __future__ import annotations

import functools
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The published rules of double metaphone. For each letter, in their order: a pattern that is tried at the letter, with what stands before
#: and after it, the code that it adds, and the other code if there is one. ^ and $ are the ends of the name, @ any vowel. A rule behind <plain> doesn't hold for names with
#: Slavic or Germanic signs, one behind <slavic> only for them; for <german>, <mc>, <san>, <sch> see NAMES.
RULES = {
    "AEIOUY": (("^@", "A"), ("@", "")),
    "B": (("BB?", "P"),),
    "Ç": (("Ç", "S"),),
    "C": (
        ("(?<=[^AEIOUY]A)CH(?!I)(?:(?!E)|(?<=[BM]ACH)(?=ER))", "K"), ("^CA(?=ESAR)", "S"), ("CH(?=IA)", "K"), ("(?<=.)CH(?=AE)", "K", "X"),
        ("^CH(?=ARAC|ARIS|OR(?!E)|YM|IA|EM)", "K"), ("<german>CH", "K"), ("(?<=OR)CH(?=ES|ID)", "K"), ("(?<=AR)CH(?=IT)", "K"), ("CH(?=[TS])", "K"),
        ("(?:^|(?<=[AOUE]))CH(?=[LRNMBHFVW ]|$)", "K"), ("^CH", "X"), ("<mc>CH", "K"), ("CH", "X", "K"), ("(?<!WI)CZ", "S", "X"), ("CCI(?=A)", "X"),
        ("(?<=^A)CC(?=[IE]|H(?!U))", "KS"), ("(?<=U)CC(?=E[ES])", "KS"), ("(?<!^M)CC(?=[IE]|H(?!U))", "X"), ("(?<!^M)CC", "K"), ("C[KGQ]", "K"),
        ("CI(?=[OEA])", "S", "X"), ("C[IEY]", "S"), ("C [CQG]", "K"), ("CC(?![EI])", "K"), ("C", "K"),
    ),
    "D": (("DG(?=[IEY])", "J"), ("DG", "TK"), ("D[TD]?", "T")),
    "F": (("FF?", "F"),),
    "G": (
        ("^G(?=N)", ""), ("(?<=[^AEIOUY])GH", "K"), ("^GH(?=I)", "J"), ("^GH", "K"), ("(?<=[BHD].)GH|(?<=[BHD]..)GH|(?<=[BH]...)GH", ""),
        ("(?<=[CGLRT].U)GH", "F"), ("(?<=[^I])GH", "K"), ("GH", ""), ("<plain>(?<=^@)GN", "KN", "N"), ("<plain>GN(?!EY)", "N", "KN"), ("GN", "KN"),
        ("<plain>GL(?=I)", "KL", "L"), ("^G(?=Y|E[SPBLIR]|I[BLNE])", "K", "J"), ("<calm>(?<![EI])G(?:(?=ER)|(?=Y)(?<![RO]G))", "K", "J"),
        ("<german>(?:G(?=[EIY])|(?<=[AO])GG(?=I))", "K"), ("G(?=ET)", "K"), ("G(?=IER(?: |$))", "J"), ("G(?=[EIY])|(?<=[AO])GG(?=I)", "J", "K"), ("GG?", "K"),
    ),
    "H": (("(?:^|(?<=@))H(?=@)", "H"), ("H", "")),
    "J": (
        ("^J(?=OSE(?: |$))", "H"), ("<san>J", "H"), ("J(?=OSE)", "J", "H"), ("^JJ?", "J", "A"), ("<plain>(?<=@)J(?=[AO])", "J", "H"), ("J$", "J", ""),
        ("(?<![SKL])J(?![LTKSNMBZ])J?", "J"), ("JJ?", ""),
    ),
    "K": (("^K(?=N)", ""), ("KK?", "K")),
    "L": (("(?<=I)LL(?=[OA]$)|(?<=A)LL(?=E$)|(?<=A)LL(?=E.*(?:[AO]S|[AO])$)", "L", ""), ("LL?", "L")),
    "M": (("(?<=U)MB(?=$|ER)", "M"), ("MM?", "M")),
    "NÑ": (("NN?|Ñ", "N"),),
    "P": (("^P(?=[NS])", ""), ("PH", "F"), ("P[PB]?", "P")),
    "Q": (("QQ?", "K"),),
    "R": (("<plain>(?<=IE)(?<!M[EA]IE)R$", "", "R"), ("RR?", "R")),
    "S": (
        ("(?<=[IY])S(?=L)", ""), ("^S(?=UGAR)", "X", "S"), ("SH(?=EIM|OEK|OLM|OLZ)", "S"), ("SH", "X"), ("<plain>SI(?=[OA])", "S", "X"), ("SI(?=[OA])", "S"),
        ("^S(?=[MNLW])", "S", "X"), ("SZ", "S", "X"), ("SCH(?=E[RN])", "X", "SK"), ("SCH(?=OO|UY|E[DM])", "SK"), ("^SCH(?![AEIOUYW])", "X", "S"), ("SCH", "X"),
        ("SC(?=[IEY])", "S"), ("SC", "SK"), ("(?<=[AO]I)S$", "", "S"), ("SS?", "S"),
    ),
    "T": (("TI(?=ON|A)", "X"), ("TCH", "X"), ("TH(?=[OA]M)", "T"), ("<german>T(?:H|T(?=H))", "T"), ("TH|TT(?=H)", "0", "T"), ("T[TD]?", "T")),
    "V": (("VV?", "F"),),
    "W": (
        ("^W(?=R)", ""), ("WR", "R"), ("^WI[CT]Z", "ATS", "FFX"), ("^W(?=@)", "A", "F"), ("^W(?=H)", "A"), ("(?<=@)W$", "", "F"), ("(?<=[EO])W(?=SK[IY])", "", "F"),
        ("<sch>W", "", "F"), ("WI[CT]Z", "TS", "FX"), ("W", ""),
    ),
    "X": (("^X", "S"), ("(?<=[AO]U)X$", ""), ("X[CX]?", "KS")),
    "Z": (("ZH", "J"), ("ZZ(?=[OIA])", "S", "TS"), ("<slavic>(?<=[^T])ZZ?", "S", "TS"), ("ZZ?", "S")),
}

#: What a rule can ask of the whole name.
NAMES = {"slavic": "W|K|CZ", "german": "^(?:VAN |VON |SCH)", "mc": "^MC", "san": "^SAN ", "sch": "^SCH", "anger": "^[DRM]ANGER"}


@functools.lru_cache(maxsize=None)
def _rules_for(signs: frozenset[str]) -> dict[str, list[tuple[re.Pattern[str], str, str]]]:
    """The rules of each letter that can hold for a name with these signs."""
    held = signs | {free for free, bound in (("plain", "slavic"), ("calm", "anger")) if bound not in signs}
    out = {}
    for letters, rules in RULES.items():
        asked = [re.fullmatch(r"(?:<(\w+)>)?(.*)", rule[0]).groups() for rule in rules]
        kept = [(re.compile(body.replace("@", "[AEIOUY]")), *rule[1:2], rule[-1]) for rule, (sign, body) in zip(rules, asked, strict=True) if sign is None or sign in held]
        out |= dict.fromkeys(letters, kept)
    return out


def codes(name: str, length: int | None = 4) -> tuple[str, str]:
    """The two codes of a name, cut to `length` signs (None: whole); equal where a name is said in one way. Signs that no rule knows are silent."""
    name = name.upper()
    rules = _rules_for(frozenset(sign for sign, pattern in NAMES.items() if re.search(pattern, name)))
    first, other, at = [], [], 0
    while at < len(name):
        for pattern, code, second in rules.get(name[at], ()):
            if met := pattern.match(name, at):
                first.append(code)
                other.append(second)
                at = met.end()
                break
        else:
            at += 1
    return "".join(first)[:length], "".join(other)[:length]


def double_metaphone(c: Column, length: int | None = 4) -> Column:
    """A struct (code, other) of a text's two codes; null for null. Accents are to be folded before. Each different text of a batch is coded once."""

    @F.pandas_udf("code string, other string")
    def coded(texts: pd.Series) -> pd.DataFrame:
        known = {t: codes(t, length) for t in texts.dropna().unique()}
        return pd.DataFrame([known.get(t, (None, None)) for t in texts], columns=["code", "other"])

    found = coded(c)
    return F.when(c.isNotNull(), found)


def metaphone_key(c: Column) -> Column:
    """The first code of a folded text's first two words, as a key for linkage; null for texts without a code."""
    return F.nullif(double_metaphone(F.array_join(F.slice(F.split(c, " "), 1, 2), " "))["code"], F.lit(""))
