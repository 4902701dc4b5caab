"""Canonical labels and text keys.

The words of part names stand for raw spellings. The SQL side maps each word
straight to the expected label, so it shares no rule with the Spark side.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import classify, text, values
from ..operators import catalogue
from . import inputs
from .inputs import noun, phrase, spread, sql_phrase, table
from .registry import query

NOUN_SQL = "split_part(p_name, ' ', 2)"


def _labelled(spark, sf, raw: dict[str, str], label, key=None):
    """Label every order line by its part's noun and count. The rules run once
    per distinct raw value; rows are counted per value first."""
    rows = table(spark, sf, "lineitem").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        phrase(noun(F.col("p_name")), raw).alias("raw"))
    counted = rows.groupBy("raw").agg(F.count("*").alias("_n"))
    if key is not None:
        counted = counted.withColumn("key", key(F.col("raw")))
    return counted.select(label(F.col("raw")).alias("label"), "_n").groupBy("label").agg(F.sum("_n").alias("n"))


def _label_sql(expected: dict[str, str | None]) -> str:
    return (f"SELECT {sql_phrase(NOUN_SQL, expected)} AS label, count(*) AS n "
            "FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")


ORGANISMS = {
    "anvil": ("Levures et Moisissures", "Yeasts and moulds"),
    "bolt": ("E. coli O157:H7", "Escherichia coli O157"),
    "gear": ("STEC (Shiga toxin-producing Escherichia coli )", "Shiga toxin-producing E. coli (STEC)"),
    "gizmo": ("SALMONELLA", "Salmonella spp."),
    "plate": ("Enterobacterales", "Enterobacteriaceae"),
    "ring": ("  Unheard  of (bug ) ;", "Unheard of (bug)"),
    "rod": ("Listeria spp. and L. monocytogenes", "Listeria spp. and L. monocytogenes"),
    "widget": ("Stérilité commerciale", "Commercial sterility"),
}


@query("organism_labels", _label_sql({k: v[1] for k, v in ORGANISMS.items()}))
def organism_labels(spark, sf):
    return _labelled(spark, sf, {k: v[0] for k, v in ORGANISMS.items()},
                     lambda c: classify.organism(c, key=F.col("key")), text.fold_key)


MAKERS = {
    "anvil": ("BioMérieux S.A. - Marcy L'Etoile", "bioMérieux"), "bolt": ("BIO-RAD", "Bio-Rad"),
    "gear": ("Oxoid Ltd (part of Termo Fisher)", "Thermo Fisher Scientific"),
    "gizmo": ("Merck Millipore SAS", "MilliporeSigma (Merck)"),
    "plate": ("Life Technologies Coporation", "Thermo Fisher Scientific"),
    "ring": ("Nobody   Known, ", "Nobody Known"), "rod": ("Solus Scientific Solutions", "Solus Scientific (PerkinElmer)"),
    "widget": ("Schimadzu", "Schimadzu"),
}


@query("manufacturer_labels", _label_sql({k: v[1] for k, v in MAKERS.items()}))
def manufacturer_labels(spark, sf):
    return _labelled(spark, sf, {k: v[0] for k, v in MAKERS.items()},
                     lambda c: classify.manufacturer(c, key=F.col("key")), text.fold_key)


LABS = {
    "anvil": ("ADRIA Développement ZA Creac'h Gwen", "ADRIA Développement"), "bolt": ("For", None),
    "gear": ("W. Jacobs-Reitsma", None), "gizmo": ("Nofima AS", "Nofima AS"), "plate": ("laboratory", None),
    "ring": ("IPL Santé, Lille", "Institut Pasteur de Lille"), "rod": ("XY", None),
    "widget": ("LDA 22", "Labocea"),
}


@query("laboratory_labels", _label_sql({k: v[1] for k, v in LABS.items()}))
def laboratory_labels(spark, sf):
    return _labelled(spark, sf, {k: v[0] for k, v in LABS.items()},
                     lambda c: classify.expert_lab(c, key=F.col("key")), text.fold_key)


PRODUCTS = {"anvil": "iQ-Check kit", "bolt": "Fossomatic 7", "gear": "Rida Count", "gizmo": "VIDAS up",
            "plate": "TEMPO card", "ring": "Mystery", "rod": "Real-Time PCR agar", "widget": "Unknown"}


@query("method_technology", f"""
SELECT CASE WHEN p_type = 'PROMO' THEN 'culture_media' WHEN p_type = 'LARGE' THEN 'biochemical'
            ELSE COALESCE({sql_phrase(NOUN_SQL, {"anvil": "molecular_pcr", "bolt": "flow_cytometry", "gear": "culture_media", "gizmo": "immunological_elisa", "plate": "biochemical", "rod": "molecular_pcr"})},
                 CASE WHEN p_size > 40 THEN 'inhibition_assay' WHEN p_type = 'SMALL' THEN 'other' END) END AS label, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def method_technology(spark, sf):
    stated = phrase(F.col("p_type"), {"PROMO": "chromogenic_agar", "LARGE": "biochemical", "SMALL": "other"})
    name = phrase(noun(F.col("p_name")), PRODUCTS)
    evidence = F.when(F.col("p_size") > 40, "inhibition_assay")
    rows = table(spark, sf, "lineitem").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        stated.alias("stated"), F.lower(name).alias("name"), evidence.alias("evidence"))
    counted = rows.groupBy("stated", "name", "evidence").agg(F.count("*").alias("_n"))
    return (counted.select(classify.technology(F.col("stated"), F.col("name"), F.col("evidence"),
                                               key=F.col("name")).alias("label"), "_n")
            .groupBy("label").agg(F.sum("_n").alias("n")))


AIMS = {
    "anvil": ("Recherche de SALMONELLA", "Salmonella spp.", None),
    "bolt": ("DETECTION of Listeria monocytogenes and enumeration", "Listeria monocytogenes", "detection"),
    "gear": ("Dénombrement of aerobic flora", "Aerobic mesophilic flora / total viable count", "enumeration"),
    "gizmo": ("DÉTECTION E. coli O157", "E. coli O157", "detection"),
    "plate": ("enumeration of e. coli", "E. coli", "enumeration"),
    "ring": ("nothing", None, None), "rod": ("denombrement shiga toxin STEC", "Shiga toxin-producing E. coli (STEC)", "enumeration"),
    "widget": ("Lactic Acid Bacteria", "Lactic acid bacteria", None),
}


@query("aim_of_method", f"""
SELECT {sql_phrase(NOUN_SQL, {k: v[1] for k, v in AIMS.items()})} AS target,
       {sql_phrase(NOUN_SQL, {k: v[2] for k, v in AIMS.items()})} AS action, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def aim_of_method(spark, sf):
    rows = table(spark, sf, "lineitem").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        phrase(noun(F.col("p_name")), {k: v[0] for k, v in AIMS.items()}).alias("aim"))
    counted = rows.groupBy("aim").agg(F.count("*").alias("_n"))
    return (counted.select(classify.target_of_list(F.col("aim")).alias("target"),
                           classify.action(F.col("aim")).alias("action"), "_n")
            .groupBy("target", "action").agg(F.sum("_n").alias("n")))


TARGETS = {"anvil": ("Shiga Toxin producers", "Shiga toxin-producing E. coli (STEC)"),
           "bolt": ("pathogenic E. coli", "Shiga toxin-producing E. coli (STEC)"),
           "gear": ("Yeast and Mold", "Yeasts and molds"), "gizmo": ("aerobic count", None),
           "plate": ("listeria", "Listeria spp."), "ring": (None, None),
           "rod": ("antibiotic residues", "Antibiotic residues"), "widget": ("Staphylococcus", "Coagulase-positive staphylococci")}


@query("certificate_targets", _label_sql({k: v[1] for k, v in TARGETS.items() if v[0]}))
def certificate_targets(spark, sf):
    return _labelled(spark, sf, {k: v[0] for k, v in TARGETS.items() if v[0]},
                     lambda c: classify.target_of_certificate(c, F.lit(None).cast("string")))


PRINCIPLES = {"anvil": ("uses qPCR chemistry", "molecular_pcr"), "bolt": ("colour change of the gel", "chromogenic_agar"),
              "gear": ("immuno-concentration", "immunological_elisa"), "gizmo": ("spcra only", "other"),
              "plate": ("Lateral Flow strip", "immunological_elisa"), "ring": ("real time PCR", "molecular_pcr"),
              "rod": ("", "other"), "widget": ("isothermal Amplification chromogenic", "molecular_pcr")}


@query("section_technology", _label_sql({k: v[1] for k, v in PRINCIPLES.items()}))
def section_technology(spark, sf):
    return _labelled(spark, sf, {k: v[0] for k, v in PRINCIPLES.items()},
                     lambda c: classify.technology_from_sections(c, F.lit("kit")))


SLUGS = {"anvil": ("e-coli-o157", "E. coli O157"), "bolt": ("saved-e-coli-o157-page", "E. coli O157"),
         "gear": ("my-e-coli", "E. coli"), "gizmo": ("listeria-spp-et-listeria-monocytogenes", "Listeria spp. and L. monocytogenes"),
         "plate": ("stec-shiga-toxine", "Shiga toxin-producing E. coli (STEC)"), "ring": ("nothing-known", "Page heading"),
         "rod": ("flore-totale", "Aerobic mesophilic flora / total viable count"), "widget": ("salmonella", "Salmonella spp.")}


@query("slug_organisms", _label_sql({k: v[1] for k, v in SLUGS.items()}))
def slug_organisms(spark, sf):
    return _labelled(spark, sf, {k: v[0] for k, v in SLUGS.items()},
                     lambda c: classify.organism_of_slug(c, F.lit("Page heading")))


HEADINGS = {"anvil": ("Milieux de culture", "culture_media"), "bolt": ("MÉTHODES MOLÉCULAIRES", "molecular_pcr"),
            "gear": ("tests imuno-enzymatiques", "immunological_elisa"), "gizmo": ("Cytométrie en flux ", "flow_cytometry"),
            "plate": ("Autres", "other"), "ring": ("Milieux", "other"), "rod": ("tests immunologiques", "immunological_elisa"),
            "widget": ("Tests de biologie moléculaire", "molecular_pcr")}


@query("heading_technology", _label_sql({k: v[1] for k, v in HEADINGS.items()}))
def heading_technology(spark, sf):
    return _labelled(spark, sf, {k: v[0] for k, v in HEADINGS.items()},
                     classify.technology_from_heading)


@query("organism_residual", f"""
SELECT {sql_phrase(NOUN_SQL, {'ring': ORGANISMS['ring'][0], 'widget': 'Odd one'})} AS raw, count(*) AS n
FROM part WHERE {NOUN_SQL} IN ('ring', 'widget') GROUP BY 1""")
def organism_residual(spark, sf):
    from ..functions.rules import lookup
    raw = {k: v[0] for k, v in ORGANISMS.items()} | {"widget": "Odd one"}
    rows = (table(spark, sf, "part").select(phrase(noun(F.col("p_name")), raw).alias("raw"))
            .withColumn("key", text.fold_key(F.col("raw"))))
    aliases = [(a, label) for label, names in vocab.ORGANISM_ALIASES for a in names]
    return catalogue.residual(rows, "raw", lookup(F.col("key"), aliases))


@query("text_keys", r"""
SELECT doc_id, md5(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '', 'g')) AS fold,
       md5(regexp_replace(upper(replace(text, 'ß', 'SS')), '[^A-Z0-9]+', '', 'g')) AS name_key,
       md5(trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-')) AS slug,
       md5(trim(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '\s+([)\]])', '\1', 'g'), ' ,;_-')) AS tidy
FROM documents""")
def text_keys(spark, sf):
    t = F.col("text")
    # A file of one row group is one task, and the keys cost far more than dealing the texts.
    return spread(table(spark, sf, "documents"), "doc_id").select(
        "doc_id", F.md5(text.fold_key(t)).alias("fold"), F.md5(text.name_key(t)).alias("name_key"),
        F.md5(text.slug(t)).alias("slug"), F.md5(text.tidy(t)).alias("tidy"))


@query("printed_values", """
SELECT l_orderkey, l_linenumber_s, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS english,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS french, 'AB ' || lpad(CAST(l_suppkey % 90 + 10 AS VARCHAR), 2, '0') || '/02-03/04' AS number, count(*) AS n
FROM (SELECT *, CAST(l_linenumber AS VARCHAR) AS l_linenumber_s FROM lineitem) GROUP BY ALL""")
def printed_values(spark, sf):
    d = F.col("l_shipdate")
    price = F.format_string("value -- -%d,%02d", (F.round(F.col("l_extendedprice") * 100) / 100).cast("bigint"),
                            F.round(F.col("l_extendedprice") * 100).cast("bigint") % 100)
    month = F.element_at(F.array(*[F.lit(m) for m in vocab.FRENCH_MONTHS]), F.month(d))
    english = F.concat(F.lit("Issued on "), F.date_format(d, "MMMM d, yyyy"))
    french = F.concat_ws(" ", F.lit("mise à jour le"), F.dayofmonth(d), month, F.year(d))
    number = F.concat(F.lit("AB "), F.lpad((F.col("l_suppkey") % 90 + 10).cast("string"), 2, "0"),
                      F.lit(" / 02 – 03 /04"))
    cents = F.round(values.to_double(values.last_number(price)) * -100).cast("bigint")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate")
    return (spread(lines, "l_orderkey", "l_linenumber", "l_suppkey").select(
        "l_orderkey", F.col("l_linenumber").cast("string").alias("l_linenumber_s"),
        cents.alias("cents"), values.english_date(english).cast("string").alias("english"),
        values.french_date(french).cast("string").alias("french"),
        values.printed_number(number).alias("number"))
        .groupBy("l_orderkey", "l_linenumber_s", "cents", "english", "french", "number")
        .agg(F.count("*").alias("n")))
