"""Categories of organisms: site rules, nearest annotated ancestor and what groups take from members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.operators.taxonomy import nearest_annotated

#: Categories from most to least severe.
PRIORITY = ("Primary", "Opportunistic", "Potential", "Commensal", "Unknown")
#: Words that name a body site.
SITES = {
    "blood": ("blood", "serum", "plasma", "erythrocyte", "leukocyte", "whole blood", "peripheral blood", "bloodstream", "bacteremia", "sepsis", "septicemia", "hematogenous"),
    "gut": ("gut", "intestine", "intestinal", "gi", "gastrointestinal", "bowel", "colon", "colonic", "duodenum", "jejunum", "ileum", "cecum", "digestive", "enteric", "gastric", "stomach"),
    "stool": ("stool", "feces", "fecal", "faeces", "faecal", "diarrhea", "diarrhoea", "rectal", "rectum"),
    "urine": ("urine", "urinary", "bladder", "urinary bladder", "uti", "urinary tract", "nephric", "renal pelvis", "cystitis"),
    "urogenital": ("urogenital", "genitourinary", "gu", "genital", "reproductive", "vaginal", "vagina", "cervical", "cervix", "uterine", "uterus", "prostatic", "prostate", "testicular", "epididymal", "seminal"),
    "resp": ("resp", "respiratory", "respir", "pulmonary", "bronchial", "bronchi", "tracheal", "trachea", "airway", "airways"),
    "lung": ("lung", "lungs", "pulmonary", "pneumonia", "pneumonic", "alveolar", "pleural", "pleura", "pleurisy"),
    "sputum": ("sputum", "phlegm", "mucus", "expectoration", "bronchial secretion"),
    "csf": ("csf", "cerebrospinal fluid", "cerebrospinal", "spinal fluid", "meningeal", "meninges", "meningitis"),
    "brain": ("brain", "cerebral", "cerebrum", "encephalic", "encephalitis", "intracranial", "neural", "neurological"),
    "skin": ("skin", "cutaneous", "dermal", "dermis", "epidermal", "epidermis", "subcutaneous", "integument", "wound", "cellulitis"),
    "abscess": ("abscess", "pus", "purulent", "pustule", "furuncle", "carbuncle", "empyema", "pyogenic"),
    "oral": ("oral", "mouth", "buccal", "gingival", "gum", "gums", "dental", "tooth", "teeth", "periodontal", "pharyngeal", "pharynx", "throat", "tonsillar", "tonsil", "tonsils", "oropharyngeal", "nasopharyngeal"),
    "ear": ("ear", "otic", "aural", "otitis", "mastoid"),
    "cornea": ("cornea", "corneal", "eye", "ocular", "ophthalmic", "conjunctival", "conjunctiva", "keratitis"),
    "lymph": ("lymph", "lymphatic", "lymph node", "lymph nodes", "lymphadenitis", "adenitis"),
    "bone": ("bone", "osseous", "skeletal", "osteomyelitis", "joint", "articular", "arthritis", "synovial", "synovium"),
    "nasal": ("nasal", "nose", "nares", "nostril", "sinus", "sinuses", "paranasal", "rhinitis", "nasopharynx"),
    "sterile": ("sterile", "normally sterile", "sterile site", "sterile fluid", "clean", "peritoneal", "peritoneum", "ascites", "pleural fluid", "pericardial", "pericardium", "synovial fluid"),
}
#: Names of sequencing platforms; long-read ones count as one.
PLATFORMS = {
    "ont": ("pacbio", "pac bio", "pb", "ont", "nano", "nanopore", "oxford", "oxford nanopore", "oxford nan", "minion", "promethion", "gridion"),
    "illumina": ("illumina", "ilumina", "ill", "illum", "miseq", "hi seq", "hiseq", "nextseq", "nova seq", "novaseq", "unknown", ""),
}
#: Least score, in percent, by site where nothing else says it, and otherwise.
SITE_CUTOFFS = {"sterile": 10, "blood": 10, "csf": 10, "stool": 50, "oral": 45, "nasal": 45, "skin": 55, "wound": 55, "vaginal": 50}
OTHER_CUTOFF = 50
#: Severity of classes in a sheet, and the ranks whose names may stand for their genus.
SEVERITY = {"primary": 4, "opportunistic": 3, "potential": 2, "commensal": 1}
ROLLUP_RANKS = ("genus", "species", "subspecies", "strain", "serotype", "serovar")
#: Names with these belong to what infects or accompanies the genus, not to the genus.
NOT_OF_GENUS = (" phage", "prophage", " virus", " satellite")


def body_site(text: Column) -> Column:
    """The canonical site that a free text names: by a word of its list as a whole, else by one of four
    letters or more inside it (first site in the order of SITES); else the lower-cased text itself, and
    'unknown' without text."""
    low = F.trim(F.lower(F.coalesce(text, F.lit(""))))
    out = F.when(low == "", "unknown")
    for site, names in SITES.items():
        out = out.when(low.isin(*names), site)
    for site, names in SITES.items():
        out = out.when(low.rlike("|".join(n for n in names if len(n) >= 4)), site)
    return out.otherwise(low)


def platform(text: Column) -> Column:
    """The canonical platform; unknown and missing ones count as short reads, other names pass through."""
    low = F.translate(F.trim(F.lower(F.coalesce(text, F.lit("unknown")))), "_-", "  ")
    out = None
    for name, known in PLATFORMS.items():
        out = F.when(low.isin(*known), name) if out is None else out.when(low.isin(*known), name)
    return out.otherwise(low)


def least_score(explicit: Column, best: Column, preferred: Column, site: Column) -> Column:
    """struct(cutoff, origin): a sample's least score in percent.

    The explicit value wins; then `best`, a map from level to cutoff, at the preferred level and after it
    at subkey, key and toplevelkey; then the site's default.
    """
    levels = F.array_distinct(F.array(preferred, F.lit("subkey"), F.lit("key"), F.lit("toplevelkey")))
    found = F.get(F.filter(levels, lambda v: F.try_element_at(best, v).isNotNull()), F.lit(0))
    default = F.create_map(*[F.lit(x) for kv in SITE_CUTOFFS.items() for x in kv])
    say = lambda v, o: F.struct(v.cast("double").alias("cutoff"), o.alias("origin"))
    return (
        F.when(explicit.isNotNull(), say(explicit, F.lit("explicit"))).when(found.isNotNull(), say(F.try_element_at(best, found), found))
        .otherwise(say(F.coalesce(F.try_element_at(default, body_site(site)), F.lit(OTHER_CUTOFF)), F.lit("site"))))


def genus_severity(sheet: DataFrame) -> DataFrame:
    """sheet (genus, class, high_consequence) -> per lower-cased genus its most severe class, any high
    consequence and the number of entries; rows without a genus don't count."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv]), F.lower("class")), F.lit(0))
    rows = sheet.where(F.trim(F.coalesce("genus", F.lit(""))) != "").withColumn("genus", F.lower(F.trim("genus")))
    return rows.groupBy("genus").agg(
        F.max(F.struct(rank.alias("r"), F.lower("class").alias("c")))["c"].alias("class"), F.bool_or("high_consequence").alias("high_consequence"), F.count("*").alias("n"))


def match_pathogens(rows: DataFrame, sheet: DataFrame) -> DataFrame:
    """rows (taxid, name, rank, ...) -> the same with matched_by, matched, class and high_consequence.

    A row matches a sheet entry (taxid, name, genus, class, high_consequence) by its taxid, else by its
    name, else by the name's first two words, else its genus's entries taken together: a genus by its
    name, lower ranks by their name's first word unless the name is that of a phage or virus. Of entries
    that share a key the one that comes first by taxid and name holds.
    """
    low, one = F.lower(F.trim("name")), F.struct("taxid", "name")
    entry = F.struct(F.lower("class").alias("class"), "high_consequence", F.col("name").alias("matched"))
    by_taxid = sheet.where("taxid is not null").groupBy("taxid").agg(F.min_by(entry, one).alias("_t"))
    by_name = sheet.where("name is not null").groupBy(low.alias("_low")).agg(F.min_by(entry, one).alias("_n"))
    by_genus = genus_severity(sheet).select(F.col("genus").alias("_genus"), F.struct("class", "high_consequence", F.initcap("genus").alias("matched")).alias("_g"))
    own = F.lower(F.trim(F.coalesce("name", F.lit(""))))
    genus = F.when(F.lower("rank") == "genus", own).when(
        F.lower("rank").isin(*ROLLUP_RANKS) & ~own.rlike("|".join(NOT_OF_GENUS)), F.element_at(F.split(own, r"\s+"), 1))
    x = rows.withColumns({"_low": own, "_two": F.array_join(F.slice(F.split(own, r"\s+"), 1, 2), " "), "_genus": genus})
    x = x.join(by_taxid, "taxid", "left").join(by_name, "_low", "left")
    x = x.join(by_name.select(F.col("_low").alias("_two"), F.col("_n").alias("_w")), "_two", "left").join(by_genus, "_genus", "left")
    hit = F.coalesce("_t", "_n", "_w", "_g")
    how = F.when(F.col("_t").isNotNull(), "taxid").when(F.col("_n").isNotNull(), "name").when(F.col("_w").isNotNull(), "two words").when(F.col("_g").isNotNull(), "genus")
    return x.select(*rows.columns, how.alias("matched_by"), hit["matched"].alias("matched"), hit["class"].alias("class"), hit["high_consequence"].alias("high_consequence"))


def priority(category: Column) -> Column:
    """0 for the most severe category."""
    return F.coalesce(F.array_position(F.array(*[F.lit(c) for c in PRIORITY]), category), F.lit(len(PRIORITY))) - 1


def class_for_site(callclass: Column, pathogenic: Column, commensal: Column, site: Column, sterile: Column) -> Column:
    """struct(category, direct): what an annotation with free-text lists of sites says at a canonical site.

    A sterile site makes the annotation's own class direct, Primary without one. Gut and stool stand for each
    other among commensal sites alone. A class that no list confirms is indirect; missing lists hold nothing.
    """
    listed = lambda sites, s: F.coalesce(F.exists(sites, lambda x: (F.trim(x) != "") & (body_site(x) == s)), F.lit(False))
    twin = F.when(site == "stool", "gut").when(site == "gut", "stool")
    return (
        F.when(sterile, F.struct(F.coalesce(callclass, F.lit("Primary")).alias("category"), F.lit(True).alias("direct")))
        .when(listed(pathogenic, site), F.struct(F.lit("Primary").alias("category"), F.lit(True).alias("direct")))
        .when(listed(commensal, site) | listed(commensal, twin), F.struct(F.lit("Commensal").alias("category"), F.lit(True).alias("direct")))
        .otherwise(F.struct(F.coalesce(callclass, F.lit("Unknown")).alias("category"), F.lit(False).alias("direct"))))


def resolve_classes(paths: DataFrame, sheet: DataFrame, members: DataFrame, key: str, group: str) -> tuple[DataFrame, DataFrame]:
    """(per member, per group). A member has its own annotation (direct) or its nearest ancestor's
    (derived); a group takes the most severe category, any high consequence, and Mixed if both kinds occur.

    sheet: key, category, high_consequence. members: key, group.
    """
    near = nearest_annotated(paths, sheet, key).select(F.col("node").alias(key), "category", "high_consequence", (F.col("distance") == 0).alias("direct"))
    own = members.select(key, group).join(near, key, "left").select(
        key, group, F.coalesce("category", F.lit("Unknown")).alias("category"), F.coalesce("high_consequence", F.lit(False)).alias("high_consequence"),
        F.when(F.col("direct"), "Direct").when(~F.col("direct"), "Derived").alias("origin"))
    kinds = F.size(F.collect_set("origin"))
    groups = own.groupBy(group).agg(
        F.min_by("category", priority(F.col("category"))).alias("category"), F.bool_or("high_consequence").alias("high_consequence"),
        F.when(kinds > 1, "Mixed").otherwise(F.max("origin")).alias("origin"))
    return own, groups
