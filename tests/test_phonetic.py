"""Double metaphone against codes that its published rules give (written down from the rules, not from a list of their author), and its column form."""

import pytest
from pyspark.sql import functions as F

from lodeplane.functions.phonetic import codes, double_metaphone, metaphone_key

EXPECTED = """
Smith SM0 XMT; Schmidt XMT SMT; Thompson TMPS TMPS; Thomas TMS TMS; Catherine K0RN KTRN; Katherine K0RN KTRN; Richard RXRT RKRT; Bob PP PP; Eric ARK ARK; Geoff JF KF;
Dave TF TF; Ray R R; Steven STFN STFN; Randy RNT RNT; Bryce PRS PRS; Brian PRN PRN; Michael MKL MXL; Dumb TM TM; Hugh H H; Caesar SSR SSR; Chianti KNT KNT;
Chemistry KMST KMST; Chorus KRS KRS; Orchestra ARKS ARKS; Architect ARKT ARKT; Arch ARX ARK; Czerny SRN XRN; focaccia FKX FKX; bellocchio PLX PLX; bacchus PKS PKS; accident AKST AKST;
accede AKST AKST; success SKSS SKSS; Edge AJ AJ; Edgar ATKR ATKR; Laugh LF LF; McLaughlin MKLF MKLF; Cough KF KF; Rough RF RF; Tough TF TF; Ghislane JLN JLN; ghost KST KST;
biaggi PJ PK; danger TNJR TNKR; Jose HS HS; Jankelowicz JNKL ANKL; cabrillo KPRL KPR; gallegos KLKS KKS; Campbell KMPL KMPL; raspberry RSPR RSPR; rogier RJ RJR; hochmeier HKMR HKMR;
island ALNT ALNT; isle AL AL; carlisle KRLL KRLL; sugar XKR SKR; snider SNTR XNTR; schneider XNTR SNTR; school SKL SKL; schooner SKNR SKNR; schermerhorn XRMR SKRM; schenker XNKR SKNK;
resnais RSN RSNS; artois ART ARTS; Wasserman ASRM FSRM; Vasserman FSRM FSRM; Uomo AM AM; Womo AM FM; Arnow ARN ARNF; Arnoff ARNF ARNF; filipowicz FLPT FLPF; breaux PR PR; zhao J J;
Knight NT NT; Gnome NM NM; Pneumonia NMN NMN; Psalm SLM SLM; Wright RT RT; Xavier SF SFR; Tagliaro TKLR TLR; Bough P P; Hugo HK HK; Agnes AKNS ANS
"""


@pytest.mark.parametrize("line", EXPECTED.replace("\n", " ").split(";"))
def test_codes_by_the_rules(line):
    name, first, other = line.split()
    assert codes(name) == (first, other)


def test_length_and_signs_without_a_rule():
    assert codes("") == ("", "") and codes("123 -") == ("", "")
    assert codes("Architecture", None)[0].startswith(codes("Architecture")[0]) and len(codes("Architecture", None)[0]) > 4
    assert codes("san jose") == codes("SAN JOSE")


def test_columns(spark):
    df = spark.createDataFrame([(1, "smith"), (2, "schmidt"), (3, None), (4, ""), (5, "smith")], "id int, name string")
    got = {r["id"]: (r["m"] and tuple(r["m"])) for r in df.select("id", double_metaphone(F.col("name")).alias("m")).collect()}
    assert got == {1: ("SM0", "XMT"), 2: ("XMT", "SMT"), 3: None, 4: ("", ""), 5: ("SM0", "XMT")}
    names = spark.createDataFrame([("catherine wright hall",), ("katherine right",), ("",), (None,)], "name string")
    assert [r[0] for r in names.select(metaphone_key(F.col("name"))).collect()] == ["K0RN", "K0RN", None, None]
