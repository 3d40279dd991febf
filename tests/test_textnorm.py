import unicodedata

from pyspark.sql import functions as F

from kinweave.functions import textnorm as tn
from kinweave.plans.queries import INDIC_NAMES


def apply(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_norm_text_cases(spark):
    cases = {
        "Čapek & Žižka s.r.o.": "capek zizka s r o",
        "\u00c5NGSTR\u00d6M\u00a0\u2013 Bl\u00e5b\u00e6r": "angstrom blab r",
        "A\u030angstro\u0308m": "angstrom",
        "\t no.12/B; 3rd--Floor \r\n": "no 12 b 3rd floor",
        "Ĳssel №7 x² Ⅳ ㎏ ﬂor": "ijssel no7 x2 iv kg flor",
        "ＦＵＬＬ　ｗｉｄｔｈ９": "full width9",
        "za\u200dra \u200c7\u200c5": "zara 75",
        "東京 Токио": "",
        "...": "",
        "": "",
        None: "",
    }
    assert apply(spark, tn.norm_text, list(cases)) == list(cases.values())


def test_norm_text_reads_indic_scripts(spark):
    readings = INDIC_NAMES | {"कृषि\u200dघर": "krishighr", "খ\u09cb\u09be x": "khoaa x", "पि.टी-९": "pi tii 9"}
    assert apply(spark, tn.norm_text, list(readings)) == list(readings.values())
    assert [tn.fold_text(x) for x in readings] == list(readings.values())


def test_norm_text_equals_its_definition_over_all_code_points(spark):
    read = [chr(c) for c in (*range(0x3000, 0xD800), *range(0xE000, 0x110000)) if unicodedata.category(chr(c)) != "Cn" and tn.fold_text(f"x{chr(c)}x") != "x x"]
    points = [c for c in map(chr, range(1, 0x3000)) if unicodedata.category(c) not in ("Cn", "Cs")] + read + ["\ue000", "\ue0ff", "\uf8ff", "\U0001f600", "\U00020000"]
    assert len(read) > 1500
    values = [f"x{c}x A{c}" for c in points]
    wrong = [hex(ord(c)) for c, got, v in zip(points, apply(spark, tn.norm_text, values), values, strict=True) if got != tn.fold_text(v)]
    assert wrong == []


def test_norm_text_composes_indic_pairs(spark):
    pairs, *_ = tn._tables()
    values = ["ক" + p for p, _ in pairs]
    assert apply(spark, tn.norm_text, values) == [tn.fold_text(v) for v in values]


def test_strip_suffixes(spark):
    """Every suffix goes from both ends, alone, repeated or wrapped; inside a name and within words it stays."""
    cases = {"": "", "co": "", "inc co": "", "(plc)": "", "{gmbh}. 'trust'": ""}
    for k, suffix in enumerate(tn.SUFFIXES):
        other = tn.SUFFIXES[k - 1]
        cases |= {
            f"maple {suffix}": "maple",
            f"{suffix} maple": "maple",
            f"{suffix} {other} maple oak {other} {suffix}": "maple oak",
            f"maple {suffix} oak": f"maple {suffix} oak",
            f"maple{suffix} oak{suffix}": f"maple{suffix} oak{suffix}",
            f"maple [{suffix}],": "maple",
        }
    assert apply(spark, tn.strip_suffixes, list(cases)) == list(cases.values())


def test_street_number(spark):
    cases = {"48b Rue des Lilas, 75011": "48b", "7": "7", "12/3 Elm": "12", "Flat 9 Elm Lane": "", "#5 Elm": "5", "b12 Elm": "", "": "", None: ""}
    assert apply(spark, lambda c: tn.street_number(tn.norm_text(c)), list(cases)) == list(cases.values())


def test_bags(spark):
    assert apply(spark, tn.token_bag, ["oak elm oak ash", "", "x 10 9"]) == ["ash elm oak", "", "10 9 x"]
    assert apply(spark, lambda c: F.array_sort(tn.raw_tokens(c)), ["Elm;  oak\u00a0ELM; OAK,", None, " \t"]) == [["elm;", "oak", "oak,"], [], []]
