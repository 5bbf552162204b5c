"""Table shapes of the conversion."""

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()

FIELDS = T.StructType([
    T.StructField("record_id", S), T.StructField("ord", I), T.StructField("tag", S),
    T.StructField("ind1", S), T.StructField("ind2", S), T.StructField("value", S),
])

SUBFIELDS = T.StructType([
    T.StructField("record_id", S), T.StructField("ord", I), T.StructField("tag", S),
    T.StructField("ind1", S), T.StructField("ind2", S), T.StructField("sf_ord", I),
    T.StructField("code", S), T.StructField("value", S),
])

# obj_kind is 'uri' | 'bnode' | 'literal'; lang / datatype only for literals
TRIPLES = T.StructType([
    T.StructField("record_id", S), T.StructField("subj", S), T.StructField("pred", S),
    T.StructField("obj", S), T.StructField("obj_kind", S), T.StructField("lang", S),
    T.StructField("datatype", S), T.StructField("rule", S),
])
TRIPLE_COLS = [f.name for f in TRIPLES.fields]

REJECTS = T.StructType([
    T.StructField("source", S), T.StructField("frame_no", I), T.StructField("stage", S),
    T.StructField("reason", S), T.StructField("n_bytes", I),
])

# MARCXML as read by the XML source: explicit so tags stay strings ('001')
MARCXML_RECORD = T.StructType([
    T.StructField("_type", S),
    T.StructField("leader", S),
    T.StructField("controlfield", T.ArrayType(T.StructType([
        T.StructField("_tag", S), T.StructField("_VALUE", S)]))),
    T.StructField("datafield", T.ArrayType(T.StructType([
        T.StructField("_tag", S), T.StructField("_ind1", S), T.StructField("_ind2", S),
        T.StructField("subfield", T.ArrayType(T.StructType([
            T.StructField("_code", S), T.StructField("_VALUE", S)])))]))),
])
