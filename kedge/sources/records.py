"""Reading records: JSON lines, JSON objects, maps of records, item JSON, files."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, *, strict: bool = True) -> DataFrame:
    """Rows of JSON lines under an explicit schema; with ``strict`` a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)


def unknown_keys(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``line, keys``: top-level keys the schema doesn't know, which a JSON read would drop silently."""
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    return lines.withColumn("keys", F.array_except(F.json_object_keys("line"), known)).where("size(keys) > 0")


def json_object(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The one row of a file that holds one JSON object."""
    read = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return (read.schema(schema) if schema else read).json(path)


def json_map(spark: SparkSession, path: str, value: str, *, field: str | None = None) -> DataFrame:
    """``key`` and the fields of each record of a file that maps keys to records (at ``field``, or as a whole)."""
    whole = spark.read.text(path, wholetext=True)
    held = f"struct<{field}:map<string,{value}>>" if field else f"map<string,{value}>"
    parsed = F.from_json("value", held, {"mode": "FAILFAST"})
    return whole.select(F.explode(parsed[field] if field else parsed).alias("key", "record")).select("key", "record.*")


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The Parquet table at ``path``, or an empty one where there is none yet."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


#: Shape of one item of the sequential source.
ITEM = (
    "id string, current_question struct<id:string,content:string,resources_path:array<string>,type:string,is_additional:boolean>, "
    "current_answers array<struct<id:string,title:string,resources_path:array<string>>>, "
    "questions_count int, question_number int, questions_passed int, valid_answers string"
)


def id_list(c: Column) -> Column:
    """Trimmed ids of a comma list or a JSON array in text; null if there is none or one is no UUID."""
    listed = F.coalesce(F.from_json(c, "array<string>"), F.split(c, ","))
    ids = F.transform(listed, lambda x: F.lower(F.trim(x)))
    return F.when((F.size(ids) > 0) & F.forall(ids, lambda x: x.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")), ids)


def item_problem(raw: Column) -> Column:
    """Why an item can't be taken: malformed, ended (it holds no question), resources (not a list), valid_answers, missing (a critical field); null if it can."""
    x = F.from_json(raw, ITEM)
    q, answers = x["current_question"], x["current_answers"]
    listed = F.coalesce(F.ltrim(F.get_json_object(raw, "$.current_question.resources_path")).startswith("["), F.lit(False))
    needed = [q["id"], q["content"], q["type"], x["question_number"], x["questions_count"], x["questions_passed"], answers]
    some_null = F.exists(answers, lambda a: a["id"].isNull() | a["title"].isNull())
    return (
        F.when(F.try_parse_json(raw).isNull(), "malformed").when(q.isNull(), "ended").when(~listed | F.exists(answers, lambda a: a["resources_path"].isNull()), "resources")
        .when(id_list(x["valid_answers"]).isNull(), "valid_answers").when(F.greatest(*[c.isNull() for c in needed]) | some_null, "missing")
    )


def checked_items(df: DataFrame, *, raw: str) -> tuple[DataFrame, DataFrame]:
    """(``df`` with ``item`` for the items that can be taken, the others with ``problem``): nothing is taken with nulls in critical fields."""
    marked = df.withColumn("problem", item_problem(F.col(raw)))
    return marked.where("problem is null").drop("problem").withColumn("item", items(F.col(raw))), marked.where("problem is not null")


def items(raw: Column) -> Column:
    """Question struct of one item's JSON. Unknown keys are ignored; missing parts are null (``checked_items`` rejects them)."""
    x = F.from_json(raw, ITEM)
    right = id_list(x["valid_answers"])
    resource = lambda urls: F.transform(F.coalesce(urls, F.array().cast("array<string>")), lambda u: F.struct(u.alias("url")))
    return F.struct(
        x["current_question"]["id"].alias("official_id"), x["question_number"].alias("position_no"), x["current_question"]["content"].alias("text"),
        x["current_question"]["type"].alias("question_type"), (x["current_question"]["type"] == "multiple").alias("multiple"), x["current_question"]["is_additional"].alias("is_additional"),
        resource(x["current_question"]["resources_path"]).alias("resources"),
        F.transform(x["current_answers"], lambda a: F.struct(a["id"].alias("id"), a["title"].alias("text"), resource(a["resources_path"]).alias("resources"), F.array_contains(right, a["id"]).alias("correct"))).alias("answers"),
        right.alias("correct_answer_ids"), x["questions_count"].alias("total"),
    )


def file_hashes(spark: SparkSession, path: str, *, pattern: str | None = None) -> DataFrame:
    """``path, sha256, bytes`` of every file under a folder."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        read = read.option("pathGlobFilter", pattern)
    root = str(Path(path).resolve()) if "://" not in path else path
    name = F.regexp_replace(F.regexp_replace("path", r"^file:/+", "/"), "^" + "\\Q" + root.rstrip("/") + "\\E/", "")
    return read.load(path).select(name.alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
