"""Raw responses to clean rows: ids, recovered objects, nested rows, statistics, consolidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import PROMPT_TYPES
from ..functions import recovery
from ..functions.running import running_sums
from ..schemas import RESPONSE
from ..sources.staging import staged

TYPES = tuple(PROMPT_TYPES.values())
_NUMBER = r"_prompt(\d+)"


def parse_lines(lines: DataFrame) -> DataFrame:
    """Response lines (value) with their fields; a line that isn't JSON has an error and nothing else."""
    body = lines.where(F.trim("value") != "")
    r = F.from_json("value", RESPONSE)
    parsed = body.select("*", r.alias("r"), F.try_parse_json("value").isNotNull().alias("sound"))
    content = F.get(F.col("r.response.body.choices"), F.lit(0))["message"]["content"]
    code = F.col("r.response.status_code")
    error = F.when(~F.col("sound"), "not JSON").when(code.isNull(), "no response").when(code != 200, F.concat(F.lit("status "), code.cast("string"))).when(F.get(F.col("r.response.body.choices"), F.lit(0)).isNull(), "no choices")
    return parsed.select(*[c for c in lines.columns if c != "value"], F.col("r.custom_id").alias("custom_id"), code.alias("status_code"), F.coalesce(content, F.lit("")).alias("content"), F.col("r.response.body.usage").alias("usage"), error.alias("error"))


def prompt_type(custom_id: Column | str, compat: bool = False) -> Column:
    """By the id's end; compat looks for a type's name anywhere in it first."""
    number = F.regexp_extract(custom_id, _NUMBER if compat else _NUMBER + "$", 1)
    by_number = F.when(number == "1", TYPES[0]).when(number == "2", TYPES[1]).when(number == "3", TYPES[2])
    if compat:
        return F.when(F.contains(custom_id, F.lit("auditoria")), "auditoria").when(F.contains(custom_id, F.lit("desembolsos")), "desembolsos").when(F.contains(custom_id, F.lit("productos")), "productos").otherwise(by_number)
    named = F.regexp_extract(custom_id, r"_(auditoria|desembolsos|productos)(?:_chunk_\d+)?$", 1)
    return F.coalesce(by_number, F.when(named != "", named))


def parse_id(custom_id: Column | str) -> Column:
    """struct of project, document, type and chunk; null for an id of a single part."""
    c = F.col(custom_id) if isinstance(custom_id, str) else custom_id
    kind = prompt_type(c)
    rest = F.regexp_replace(c, "^[^_]*_", "")
    document = F.regexp_replace(rest, r"_prompt\d+$|_(auditoria|desembolsos|productos)(?=(_chunk_\d+)?$)", "")
    parts = F.split(document, "_chunk_")
    chunk = F.when(F.size(parts) == 2, F.concat(F.lit("chunk_"), F.get(parts, F.lit(1))))
    return F.when(F.contains(c, F.lit("_")), F.struct(F.substring_index(c, "_", 1).alias("project_name"), document.alias("document_name"), kind.alias("prompt_type"), chunk.alias("chunk_info")))


def objects(responses: DataFrame, compat: bool = False) -> DataFrame:
    """One row per recovered object of a successful response; a response without one gives its raw text.

    The id gets a part number where a response holds several objects.
    """
    ok = recovery.recovered(responses.where("error is null"), "content", "found", compat)
    raw = F.to_json(F.struct(F.col("content").alias("_raw_text"), F.lit("no JSON object").alias("_parse_error")))
    every = F.when(F.size("found") > 0, F.col("found")).otherwise(F.array(raw))
    each = ok.withColumn("n", F.size(every)).select("*", F.posexplode(every).alias("k", "object"))
    part = F.when(F.col("n") > 1, F.format_string("%s_part_%03d", "custom_id", F.col("k") + 1)).otherwise(F.col("custom_id"))
    return each.select(*[c for c in responses.columns if c not in ("content", "error")], part.alias("item_id"), (F.col("k") + 1).alias("part"), "object", (F.size("found") > 0).alias("recovered"), parse_id("custom_id").alias("id")).select("*", "id.*").drop("id")


def flatten_disbursements(items: DataFrame, column: str = "object") -> DataFrame:
    """Nested disbursements to one row each, planned ones first; the list's tag wins over the row, the row
    over the metadata. Numbers, booleans and nested values keep their types. Other objects pass."""
    v, kind = F.try_parse_json(column), "map<string,variant>"

    def rows(name: str, tag: str) -> Column:
        found = F.coalesce(F.try_variant_get(v, f"$.desembolsos.{name}", "array<variant>"), F.array().cast("array<variant>"))
        each = F.transform(found, lambda r: F.try_variant_get(r, "$", kind))
        return F.transform(F.filter(each, lambda r: r.isNotNull()), lambda r: _merged(r, meta, tag))

    meta = F.coalesce(F.try_variant_get(v, "$.metadata", kind), F.create_map().cast(kind))
    nested = F.concat(rows("proyectados", "proyectado"), rows("realizados", "realizado"))
    whole = F.try_variant_get(v, "$.desembolsos", kind)
    out = F.when(whole.isNotNull(), F.transform(nested, lambda m: F.to_json(m))).otherwise(F.array(F.col(column)))
    return items.select(*[c for c in items.columns if c != column], F.posexplode(out).alias("row", column))


def _merged(row: Column, meta: Column, tag: str) -> Column:
    own = F.map_filter(row, lambda k, v: k != "tipo_registro_norm")
    more = F.map_filter(meta, lambda k, v: ~F.map_contains_key(row, k) & (k != "tipo_registro_norm"))
    return F.map_concat(own, more, F.create_map(F.lit("tipo_registro_norm"), F.lit(tag).cast("variant")))


def statistics(responses: DataFrame, items: DataFrame | None = None, by: list[str] | None = None, local: bool = False, compat: bool = False) -> DataFrame:
    """Successes are objects, failures lines. local: the total counts parseable lines only.

    Without items the objects are counted as the responses are read, in one pass; with them, theirs are counted.
    """
    by, error = by or ["batch_id"], F.col("error")
    lines = [F.count_if(error.isNotNull()).alias("failed"), F.count_if(error.isNull() | (error != "not JSON")).alias("lines"), F.count_if(error.isNull()).alias("lines_ok")]
    if items is None:
        counted = recovery.recovered(responses.withColumn("_content", F.when(error.isNull(), F.col("content"))), "_content", "_found", compat)
        found = F.when(error.isNull(), F.greatest(F.size("_found"), F.lit(1))).otherwise(0)
        joined = counted.groupBy(*by).agg(*lines, F.sum(found).alias("objects_ok"))
    else:
        good = items.groupBy(*by).agg(F.count("*").alias("objects_ok"))
        joined = responses.groupBy(*by).agg(*lines).join(good, by, "left").withColumn("objects_ok", F.coalesce("objects_ok", F.lit(0)))
    total = F.col("lines") if local else F.col("objects_ok") + F.col("failed")
    successful = F.col("lines_ok") if local else F.col("objects_ok")
    rate = F.coalesce(F.try_divide(100.0 * successful, total), F.lit(0.0))
    return joined.select(*by, total.alias("total"), successful.alias("successful"), "failed", rate.alias("success_rate"), "objects_ok", "lines_ok")


def by_document(items: DataFrame) -> DataFrame:
    """Per document and type its objects in order of their ids."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("item_id", "part", "object"))), lambda x: x["object"])
    return items.groupBy("document_name", "prompt_type").agg(listed.alias("objects"))


def by_type(items: DataFrame) -> DataFrame:
    """Number of objects per type; every type has a row and unknown types have none."""
    types = items.sparkSession.createDataFrame([(t,) for t in TYPES], "prompt_type string")
    return F.broadcast(types).join(items.groupBy("prompt_type").count(), "prompt_type", "left").select("prompt_type", F.coalesce("count", F.lit(0)).alias("n"))


def pivot_types(items: DataFrame) -> DataFrame:
    return items.groupBy("document_name").pivot("prompt_type", list(TYPES)).agg(F.count(F.lit(1))).na.fill(0)


def consolidate(stored: DataFrame, current: DataFrame, keys: list[str], order: str, compat: bool = False) -> DataFrame:
    """Per key the latest of the stored and current items; compat: the stored ones alone if there are any."""
    if compat:
        return stored if stored.limit(1).count() else current
    both = stored.unionByName(current, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def document_files(items: DataFrame, compat: bool = False) -> DataFrame:
    """Result file per document and type; compat lets the last item overwrite the others."""
    path = F.concat_ws("/", F.initcap("prompt_type"), F.concat("document_name", F.lit(".json")))
    rows = items.where("prompt_type is not null").withColumn("path", path)
    if compat:
        return rows.groupBy("path").agg(F.max_by("object", "item_id").alias("value"))
    return rows.groupBy("path").agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "object"))), lambda x: x["object"]), ","), F.lit("]")).alias("value"))


# The fields of each type's record, in order. TRIPLE is a value with its confidence and evidence.
TRIPLE = "triple"
RECORD_FIELDS: dict[str, tuple[tuple[str, str | None], ...]] = {
    "auditoria": (
        ("codigo_CFA", TRIPLE), ("codigo_CFX", TRIPLE), ("estado_informe_SSC", TRIPLE), ("estado_informe_SSC_norm", "null"),
        ("informe_auditoria_externa_se_entrego_SSC", TRIPLE), ("informe_auditoria_externa_se_entrego_SSC_norm", "null"),
        ("concepto_control_interno", TRIPLE), ("concepto_control_interno_norm", "no se menciona"), ("concepto_licitacion", TRIPLE), ("concepto_licitacion_norm", "no se menciona"),
        ("concepto_uso_recursos", TRIPLE), ("concepto_uso_recursos_norm", "no se menciona"), ("concepto_unidad_ejecutora", TRIPLE), ("concepto_unidad_ejecutora_norm", "no se menciona"),
        ("fecha_vencimiento_SSC", TRIPLE), ("fecha_cambio_estado_informe_SSC", TRIPLE), ("fecha_extraccion", None), ("fecha_ultima_revision", TRIPLE),
        ("status_auditoria_SSC", "Pendiente"), ("nombre_archivo", "unknown"), ("texto_justificacion", None),
    ),
    "productos": (
        ("codigo_CFA", TRIPLE), ("codigo_CFX", TRIPLE), ("descripcion_producto", TRIPLE), ("meta_producto", TRIPLE), ("meta_unidad", TRIPLE), ("meta_num", None), ("meta_unidad_norm", None),
        ("fuente_indicador", TRIPLE), ("fecha_cumplimiento_meta", TRIPLE), ("tipo_dato", TRIPLE), ("tipo_dato_norm", None), ("caracteristica", TRIPLE), ("caracteristica_norm", None),
        ("check_producto", "No"), ("fecha_extraccion", None), ("fecha_ultima_revision", TRIPLE), ("nombre_archivo", "unknown"),
    ),
    "desembolsos": (
        ("codigo_CFA", TRIPLE), ("tipo_registro", TRIPLE), ("tipo_registro_norm", None), ("fecha_desembolso", TRIPLE), ("monto_original", TRIPLE), ("moneda", TRIPLE), ("monto_usd", TRIPLE),
        ("fuente_etiqueta", TRIPLE), ("fuente_norm", None), ("fecha_extraccion", None), ("fecha_ultima_revision", TRIPLE), ("nombre_archivo", "unknown"),
    ),
}
PREVIEW = 200


def default_record(kind: str, content: Column, stamp: Column) -> Column:
    """A type's record in which nothing was extracted, as JSON text, with the beginning of the text that it stands for."""
    none = F.lit(None).cast("string")
    triple = F.struct(none.alias("value"), F.lit("NO_EXTRAIDO").alias("confidence"), none.alias("evidence"))
    given = {"fecha_extraccion": F.date_format(stamp, "yyyy-MM-dd HH:mm"), "texto_justificacion": F.struct(none.alias("quote"))}
    fields = [(triple if v == TRIPLE else given.get(name, F.lit(v).cast("string"))).alias(name) for name, v in RECORD_FIELDS[kind]]
    notes = [F.lit("no JSON object").alias("_parse_error"), F.left(content, F.lit(PREVIEW)).alias("_original_content_preview")]
    return F.to_json(F.struct(*fields, *notes), {"ignoreNullFields": "false"})


def materialise(items: DataFrame, column: str = "object", kind: str = "prompt_type", stamp: Column | None = None) -> DataFrame:
    """The JSON that a result file should hold, in place of each item's text.

    The raw text of an unparsed response is searched again: one object stands for itself, several become an
    array. Without any, a wrapper leaves its other fields or the raw text as a string; text that is no JSON
    becomes its type's default record. Empty objects and arrays become null.
    """
    stamp = F.current_timestamp() if stamp is None else stamp
    names = items.columns
    v = F.try_parse_json(column)
    fields = F.try_variant_get(v, "$", "map<string,variant>")
    wrapped = F.coalesce(F.map_contains_key(fields, "_raw_text"), F.lit(False))
    plain = v.isNull() | F.schema_of_variant(v).isin("STRING", "VOID")
    raw = F.when(wrapped, F.get_json_object(column, "$._raw_text")).when(plain, F.coalesce(F.try_variant_get(v, "$", "string"), F.col(column)))
    rest = F.map_filter(fields, lambda k, _: ~k.isin("_raw_text", "_parse_error"))
    useful = F.size(F.map_filter(rest, lambda _, x: ~F.is_variant_null(x))) > 0
    default = F.coalesce(*[F.when(F.col(kind) == t, default_record(t, raw, stamp)) for t in TYPES], default_record(TYPES[0], raw, stamp))
    known = recovery.recovered(items.withColumn("_raw", raw), "_raw", "_found")
    found = F.col("_found")
    out = F.when(F.size(found) == 1, F.get(found, F.lit(0))).when(F.size(found) > 1, F.concat(F.lit("["), F.array_join(found, ","), F.lit("]")))
    out = out.when(wrapped & useful, F.to_json(rest)).when(wrapped, F.to_json(raw.cast("variant")))
    out = out.when(plain & (F.trim(raw) != ""), default).when(~plain & ~F.col(column).rlike(r"^\s*(\{\s*\}|\[\s*\])\s*$"), F.col(column))
    return known.withColumn(column, out).select(*names)


def contents_by_type(responses: DataFrame) -> DataFrame:
    """prompt_type, custom_id, content, position, n: the extracted JSON (or the text, where there is none) of every response that has any,
    its place in its type's list, from 1, and the length of that list. Lists are in the order of ids, and of contents where an
    id comes more than once. A row per response, so no list is ever one row or in one task: places are found from ids alone, and only
    the responses of one id meet. sinks.write_contents writes them by type in the order of their ids."""
    kind = prompt_type("custom_id").alias("prompt_type")
    kept = responses.where("error is null and content <> ''").select(kind, "custom_id", "content").where("prompt_type is not null")
    ids = staged(kept.groupBy("prompt_type", "custom_id").agg(F.count("*").alias("times")), "ids")
    sizes = ids.groupBy("prompt_type").agg(F.sum("times").alias("n"))
    before = running_sums(ids, ["prompt_type"], ["custom_id"], ["times"]).drop("times")
    texts = kept.select("prompt_type", "custom_id", recovery.extract_json("content").alias("content"))
    own = F.row_number().over(Window.partitionBy("prompt_type", "custom_id").orderBy("content"))
    placed = texts.join(before, ["prompt_type", "custom_id"]).withColumn("position", F.col("before_times") + own)
    return placed.join(F.broadcast(sizes), "prompt_type").select("prompt_type", "custom_id", "content", "position", "n")


def error_lines(errors: DataFrame) -> DataFrame:
    """n_errors of a batch's error file (value): lines that aren't blank."""
    return errors.agg(F.count_if(F.trim("value") != "").alias("n_errors"))


def quarantine(items: DataFrame) -> DataFrame:
    """Items without a usable id or type."""
    return items.where("prompt_type is null or document_name is null")


def summary(items: DataFrame) -> DataFrame:
    """Per batch: documents, and objects per type."""
    counts = items.groupBy("batch_id", "prompt_type").agg(F.count("*").alias("n"))
    per = counts.where("prompt_type is not null").groupBy("batch_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("prompt_type", "n")))).alias("prompts_results"))
    docs = items.groupBy("batch_id").agg(F.count_distinct("document_name").alias("documents_processed"))
    return docs.join(per, "batch_id", "left")
