"""Nested API reports <-> long material rows, and slim records of the source APIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.functions.columns import lit_array
from attestra.session import cut_lineage

# ---- fixed values: report block -> (meta row type, meta fields, ((list field, row type), ...)) ---
BLOCKS = (
    ("europe_pmc", "europe_pmc_query_stats", None, (("articles", "europe_pmc"),)),
    ("clinical_trials", "clinical_trials_meta", ("study_count", "version_holder"), (("studies", "clinical_trials"),)),
    ("kegg", "kegg_summary", ("kegg_drug_ids", "pathway_ids", "pathway_count", "pathway_names", "longevity_pathway_flags", "truncated", "pathway_get_limit"),
     (("pathways", "kegg_pathway"),)),
    ("chembl", "chembl_molecule", ("molecule_chembl_id", "pref_name", "search_name_used"), (("mechanisms", "chembl_mechanism"), ("activities", "chembl_activity"))),
    ("pubchem_bioassays", "pubchem_bioassays_meta", ("cid", "assay_count", "nlg_skipped_reason"), (("summaries", "pubchem_bioassay"),)),
    ("openfda", None, None, (("drug_labels", "openfda_drug_label"),)),
    ("openalex_grounding", "openalex_grounding_meta", ("search_terms", "work_count"), (("works", "openalex_grounding"),)),
    ("openalex_risk", "openalex_risk_meta", ("search_terms", "work_count"), (("works", "openalex_risk"),)),
)


def _objects(v: Column) -> Column:
    return F.filter(v, lambda x: F.startswith(F.schema_of_variant(x), F.lit("OBJECT")))


def _row(source: str, content: Column) -> Column:
    return F.struct(F.lit(source).alias("source_type"), content.alias("content"))


def _typed(items: Column, source: str) -> Column:
    return F.transform(items, lambda x: _row(source, x))


def _some(content: Column, source: str) -> Column:
    """A one-row array for a non-empty object, else null."""
    text = F.to_json(content)
    return F.when(content.isNotNull() & ~text.isin("{}", "null"), F.array(_row(source, content)))


def _pick(block: Column, fields: Sequence[str]) -> Column:
    """A new object of the fields present."""
    pairs = [F.when(F.try_variant_get(block, f"$.{f}", "variant").isNotNull() & ~F.is_variant_null(F.try_variant_get(block, f"$.{f}", "variant")),
                    F.concat(F.lit(f'"{f}":'), F.to_json(F.try_variant_get(block, f"$.{f}", "variant")))) for f in fields]
    return F.try_parse_json(F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}")))


def report_to_material(reports: DataFrame, report: str = "report", keep: Sequence[str] = ()) -> DataFrame:
    """One row per record of a nested report, in report order; meta rows only when they hold something."""
    r = F.col(report)
    sub = lambda path, kind="variant": F.try_variant_get(r, path, kind)
    name = sub("$.compound_name")
    name_row = F.when(name.isNotNull() & ~F.is_variant_null(name), F.array(_row("compound_name", _pick(r, ("compound_name",)))))
    groups = [name_row, _some(sub("$.metadata"), "discover_metadata")]
    for block, meta, fields, lists in BLOCKS:
        b = sub(f"$.{block}")
        if meta:
            groups.append(_some(_pick(b, fields) if fields else sub(f"$.{block}.query_stats"), meta))
        if block == "openfda":
            ae = sub("$.openfda.adverse_events")
            groups.append(F.when(F.startswith(F.schema_of_variant(ae), F.lit("OBJECT")), F.array(_row("openfda_faers", ae))))
        for path, source in lists:
            items = _objects(sub(f"$.{block}.{path}", "array<variant>"))
            groups.append(_typed(items, source))
    empty = F.array().cast("array<struct<source_type:string,content:variant>>")
    rows = F.flatten(F.array(*[F.coalesce(g, empty) for g in groups]))
    return reports.select(*keep, F.posexplode(rows).alias("seq", "_row")).select(*keep, "seq", "_row.source_type", "_row.content")


def material_to_report(rows: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """One nested report (JSON text) per key: lists in order, the last meta row of a kind wins.

    A report is one document by nature; its size is that of the item's own records.
    """
    text = F.to_json("content")
    typed = rows.select(key, seq, "source_type", text.alias("_json"))
    per_type = typed.groupBy(key, "source_type").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(seq, "_json"))), lambda s: s["_json"]).alias("_all"), F.max_by("_json", seq).alias("_last"))
    by_type = per_type.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("source_type", F.struct("_all", "_last")))).alias("_m"))
    got = lambda t: F.try_element_at("_m", F.lit(t))
    listed = lambda t: F.concat(F.lit("["), F.array_join(F.coalesce(got(t)["_all"], F.array().cast("array<string>")), ","), F.lit("]"))
    inner = lambda t: F.nullif(F.regexp_replace(got(t)["_last"], r"^\{|\}$", ""), F.lit(""))
    parts = [inner("compound_name"), F.concat(F.lit('"metadata":'), got("discover_metadata")["_last"])]
    for block, meta, fields, lists in BLOCKS:
        body = [F.concat(F.lit(f'"{path}":'), listed(source)) for path, source in lists]
        if block == "openfda":
            body.insert(0, F.concat(F.lit('"adverse_events":'), F.coalesce(got("openfda_faers")["_last"], F.lit("null"))))
        if meta and fields:
            body.insert(0, inner(meta))
        elif meta:
            body.append(F.concat(F.lit('"query_stats":'), got(meta)["_last"]))
            body.append(F.concat(F.lit('"unique_count":'), F.coalesce(F.size(got(lists[0][1])["_all"]), F.lit(0)).cast("string")))
        names = [s for _, s in lists] + ([meta] if meta else []) + (["openfda_faers"] if block == "openfda" else [])
        any_row = F.coalesce(*[got(n)["_last"] for n in names]).isNotNull()
        parts.append(F.when(any_row, F.concat(F.lit(f'"{block}":{{'), F.concat_ws(",", *body), F.lit("}"))))
    return by_type.select(key, F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("report_json"))


def material_rows(files: DataFrame, text: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Rows of whole-file texts in any accepted form: JSON lines, {records: []}, {report: {}} or a bare report."""
    whole = F.try_parse_json(F.col(text))
    first = F.try_parse_json(F.try_element_at(F.filter(F.split(F.col(text), r"\r?\n"), lambda x: F.trim(x) != ""), F.lit(1)))
    is_lines = F.try_variant_get(first, "$.source_type", "string").isNotNull()
    # three forms are read from the files, so these are made and parsed once
    base = cut_lineage(files.select(*keep, F.col(text).alias("_text"), whole.alias("_whole"), is_lines.alias("_lines")))
    strict = F.parse_json(F.col("_line"))
    lines = (base.filter("_lines").select(*keep, F.posexplode(F.split("_text", r"\r?\n")).alias("seq", "_line")).filter(F.trim("_line") != "")
             .withColumn("_v", strict))
    docs = base.filter(~F.coalesce("_lines", F.lit(False)) & F.col("_whole").isNotNull())
    records = F.try_variant_get("_whole", "$.records", "array<variant>")
    recs = docs.filter(records.isNotNull()).select(*keep, F.posexplode(records).alias("seq", "_v"))
    shaped = lambda d: d.filter(F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT"))).select(
        *keep, "seq", F.try_variant_get("_v", "$.source_type", "string").alias("source_type"), F.try_variant_get("_v", "$.content", "variant").alias("content"))
    report = F.try_variant_get("_whole", "$.report", "variant")
    is_object = F.startswith(F.schema_of_variant(report), F.lit("OBJECT"))
    bare = docs.filter(records.isNull()).select(*keep, F.when(is_object, report).otherwise(F.col("_whole")).alias("report"))
    return shaped(lines).unionByName(shaped(recs)).unionByName(report_to_material(bare, keep=keep))


def load_material(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    return material_rows(files, keep=("path",))


def columnar_cells_to_rows(tables: DataFrame, keep: Sequence[str], table: str = "table") -> DataFrame:
    """An assay table given as column names plus rows of cells -> named columns (aid, title, assay_type)."""
    v = F.col(table)
    many = F.try_variant_get(v, "$.Table.Columns.Column", "array<string>")
    columns = F.coalesce(many, F.array(F.try_variant_get(v, "$.Table.Columns.Column", "string")))
    row = "struct<Cell: array<string>>"
    rows = F.coalesce(F.try_variant_get(v, "$.Table.Row", f"array<{row}>"), F.array(F.try_variant_get(v, "$.Table.Row", row)))
    # columns are placed once a table; a row takes its cells by place, those it does not have are null
    names = ("AID", "Assay Name", "AssayName", "Assay Type")
    long = tables.select(*keep, columns.alias("_cols"), rows.alias("_rows")).select(
        *keep, F.transform(lit_array(names), lambda n: F.array_position("_cols", n).cast("int") - 1).alias("_at"), F.posexplode("_rows").alias("pos", "_row"))
    got = lambda i: F.get("_row.Cell", F.get("_at", F.lit(i)))
    return long.select(*keep, "pos", got(0).try_cast("long").alias("aid"), F.coalesce(F.nullif(got(1), F.lit("")), got(2), F.lit("")).alias("title"), got(3).alias("assay_type")).filter("aid IS NOT NULL")


def slim_studies(studies: DataFrame, study: str = "study", keep: Sequence[str] = ()) -> DataFrame:
    """Deep study object -> flat fields with fallbacks."""
    g = lambda path, kind="string": F.try_variant_get(F.col(study), f"$.{path}", kind)
    ps = "protocolSection."
    design = [g(f"{ps}designModule.{prefix}{k}") for prefix in ("", "designInfo.") for k in ("phases", "phase", "phasesList")]

    def outcomes(name):
        items = _objects(g(f"{ps}outcomesModule.{name}", "array<variant>"))
        return F.to_json(F.transform(items, lambda x: F.struct(*[F.try_variant_get(x, f"$.{k}", "string").alias(k) for k in ("measure", "description", "timeFrame")])))

    measures = g("resultsSection.outcomeMeasuresModule.outcomeMeasures", "array<variant>")
    module = g("resultsSection.outcomeMeasuresModule", "variant")
    return studies.select(
        *keep, g(f"{ps}identificationModule.nctId").alias("nct_id"), g(f"{ps}identificationModule.briefTitle").alias("brief_title"),
        F.coalesce(*design).alias("phases"), g(f"{ps}conditionsModule.conditions").alias("conditions"),
        outcomes("primary_outcomes").alias("primary_outcomes"), outcomes("secondary_outcomes").alias("secondary_outcomes"),
        g(f"{ps}statusModule.overallStatus").alias("overall_status"), g(f"{ps}statusModule.startDateStruct").alias("start_date"),
        g(f"{ps}statusModule.primaryCompletionDateStruct").alias("primary_completion_date"), g(f"{ps}statusModule.completionDateStruct").alias("completion_date"),
        g(f"{ps}statusModule.studyFirstSubmitDate").alias("study_first_submit_date"), g("hasResults", "boolean").alias("has_results"),
        F.when(g("resultsSection", "variant").isNotNull(), F.struct(
            F.coalesce(~F.to_json(module).isin("{}", "null"), F.lit(False)).alias("has_outcome_measures_module"), F.size(measures).alias("outcome_measures_count"))).alias("results_summary"),
        g(f"{ps}sponsorCollaboratorsModule.leadSponsor.name").alias("lead_sponsor_name"), g(f"{ps}sponsorCollaboratorsModule.leadSponsor.class").alias("lead_sponsor_class"))


MECHANISM_FIELDS = ("target_chembl_id", "target_pref_name", "mechanism_of_action", "action_type", "direct_interaction")
ACTIVITY_FIELDS = ("activity_id", "assay_type", "assay_description", "target_pref_name", "standard_type", "standard_value", "standard_units", "pchembl_value", "molecule_pref_name")


def slim_chembl(records: DataFrame, kind: str, record: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """The fields of a mechanism or activity record that the review uses."""
    fields = MECHANISM_FIELDS if kind == "mechanism" else ACTIVITY_FIELDS
    cols = [F.try_variant_get(F.col(record), f"$.{f}", "string").alias(f) for f in fields]
    if kind == "mechanism":
        cols[0] = F.coalesce(F.try_variant_get(F.col(record), "$.target_chembl_id", "string"), F.lit("")).alias("target_chembl_id")
    return records.select(*keep, *cols)
