"""Table contracts. Every reader uses these instead of inferring a schema."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, BOOL, INT, LONG = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType()
FLOAT, DOUBLE, TIME, BINARY = T.FloatType(), T.DoubleType(), T.TimestampType(), T.BinaryType()


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


LISTING = table(path=STRING, length=LONG, modificationTime=TIME)

MANIFEST = table(
    image_path=STRING,
    image_name=STRING,
    label_name=STRING,
    is_test=BOOL,
    original_path=STRING,
    label_id=INT,
    label_prediction=INT,
)

AUGMENTED_MANIFEST = T.StructType(
    MANIFEST.fields + table(aug_version=INT, embedding_index=LONG).fields
)

EMBEDDINGS = table(embedding_index=LONG, image_path=STRING, embedding=T.ArrayType(FLOAT))

SCORED = T.StructType(
    AUGMENTED_MANIFEST.fields + table(predicted_class=INT, confidence_score=FLOAT).fields
)

CLASSES = table(label_id=INT, label_name=STRING)

LAYERS = table(layer=INT, kind=STRING, rows=INT, cols=INT, values=T.ArrayType(DOUBLE))

MODEL_CONFIG = table(
    input_size=INT,
    num_classes=INT,
    hidden_units=T.ArrayType(INT),
    clip_models=T.ArrayType(table(hub=STRING, name=STRING)),
    class_labels=T.ArrayType(STRING),
)

PROCESSOR_CONFIG = table(
    embedding_config=table(
        model_name=STRING,
        pretrained=STRING,
        device=STRING,
        batch_size=INT,
        num_workers=INT,
        pca_components=INT,
        use_standardization=BOOL,
    ),
    output_dimension=INT,
    use_pca=BOOL,
    use_standardization=BOOL,
)

DATASET_STATUS = table(
    name=STRING,
    raw_path=STRING,
    normalized_path=STRING,
    csv_path=STRING,
    embeddings_path=STRING,
    model_path=STRING,
    has_csv=BOOL,
    has_embeddings=BOOL,
    has_model=BOOL,
    stage=STRING,
)

EPOCH_METRICS = table(run_id=STRING, epoch=INT, phase=STRING, name=STRING, value=DOUBLE)

RUN_INFO = table(run_id=STRING, project=STRING, name=STRING, tags=T.ArrayType(STRING))

STAGE_STATUS = table(
    stage=STRING, completed=BOOL, time=TIME, output_path=STRING, results=STRING
)

IMAGE_PIXELS = table(image_path=STRING, height=INT, width=INT, nChannels=INT, data=BINARY)

RUN_LINES = table(run_id=STRING, line=STRING)
