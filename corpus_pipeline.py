"""Documents to packed training sequences, in five stages.

Each stage reads all that its predecessor kept, as Parquet. All but the last return the columns of
``documents``. Extra columns go along untouched. A stage on an empty table returns an empty one.
A stage's own tables go into ``staging``, one of its own if none is given.
"""

from tripgrid.llm.chosen_path import one_of_each
from tripgrid.llm.common import Staging
from tripgrid.llm.decontaminate import decontaminated
from tripgrid.llm.importance import resampled
from tripgrid.llm.packing import pack
from tripgrid.llm.queries import TOKENIZER
from tripgrid.llm.secret_scan import masked


def quality(spark, docs, sf_dir, staging=None):
    """Documents that look like the labelled good ones."""
    return resampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), staging=staging)


def near_duplicates(spark, docs, sf_dir, staging=None):
    """One document of each group of near copies."""
    return one_of_each(docs, staging=staging)


def decontamination(spark, docs, sf_dir, staging=None):
    """Documents without passages of the benchmark."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), staging=staging)


def secrets(spark, docs, sf_dir, staging=None):
    """All documents, with secrets masked."""
    return masked(docs)


def packing(spark, docs, sf_dir, staging=None):
    """Pieces of all documents with their place in the sequences."""
    return pack(docs, TOKENIZER, staging=staging)


STAGES = [
    ("quality classifier", quality), ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination), ("secret scans", secrets), ("best-fit packing", packing),
]

# Models, tokenizers and links of near copies are beyond SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written and read again; only the last one's table is left."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (_, stage) in enumerate(STAGES):
        inner, after = Staging(spark), Staging(spark)
        docs = after.table(stage(spark, docs, sf_dir, inner), f"stage{number}")
        # What the stage read and what it staged is not needed again.
        inner.remove()
        if before:
            before.remove()
        before = after
    return docs
