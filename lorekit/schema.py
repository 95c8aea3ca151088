"""Record types of the engine."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT, YES, WHOLE, REAL = T.StringType(), T.BooleanType(), T.IntegerType(), T.DoubleType()
TEXTS = T.ArrayType(TEXT)


def struct(**fields: T.DataType) -> T.StructType:
    """A type without a session, so that workers can import it too."""
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


RECORD = struct(
    id=TEXT, category=TEXT, problem=TEXT, solution=TEXT, code_pattern=TEXT, importance=TEXT, source_file=TEXT, evidence=TEXT, task_id=TEXT, experience_type=TEXT,
    root_cause_type=TEXT, task_scope=TEXT, confidence=REAL, canonical=YES, evidence_list=TEXTS, merged_from=TEXTS,
)
FIELDS = RECORD.names
MAIN_TYPES = ("spec_compliance", "functional_bug_fix", "implementation_pattern")
OPERATION = struct(action=TEXT, target_ids=TEXTS, record=RECORD, reason=TEXT)
ERROR = struct(type=TEXT, description=TEXT, message=TEXT, severity=TEXT)
CHECK = struct(
    passornot=YES, errors=T.ArrayType(ERROR), feedback=TEXT, suggestions=TEXTS, verification=T.MapType(TEXT, struct(result=struct(type=TEXT, detail=TEXT)))
)
PHASE = struct(phase=TEXT, data=struct(errors_found=T.ArrayType(ERROR), code_unchanged=YES))
TASK = struct(
    task_id=TEXT, question=TEXT, error=TEXT, final_result=struct(status=TEXT, iterations=WHOLE, final_output=TEXT, check_result=CHECK),
    metrics=struct(iterations=WHOLE, total_time_seconds=REAL), phases=T.ArrayType(PHASE),
)
RUN_LOG = T.StructType([T.StructField("tasks", T.ArrayType(TASK)), *TASK.fields])
RESPONSES = struct(prompt_kind=TEXT, source_file=TEXT, task_id=TEXT, ord=T.LongType(), response=TEXT)


#: Records as they come: a number may be quoted.
LOOSE = T.StructType([T.StructField(f.name, TEXT) if f.name == "confidence" else f for f in RECORD.fields])


def typed(record: Column) -> Column:
    """A record read as LOOSE, as a RECORD; a confidence that is no number is null. A null record stays null."""
    number = F.nullif(F.trim(record["confidence"]), F.lit("")).try_cast("double")
    return F.when(record.isNotNull(), F.struct(*(number.alias(f) if f == "confidence" else record[f].alias(f) for f in FIELDS)))


def as_records(df: DataFrame) -> DataFrame:
    """df with every record field: those it lacks are null, those of the constructor's defaults are filled."""
    have = set(df.columns)
    for f in RECORD.fields:
        if f.name not in have:
            empty = "" if f.name in ("id", "category", "problem", "solution") else "medium" if f.name == "importance" else None
            df = df.withColumn(f.name, F.lit(empty).cast(f.dataType))
    return df


def barrier(df: DataFrame) -> DataFrame:
    """df, its columns computed once: else the optimiser copies long expressions into every later use and filter."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))
