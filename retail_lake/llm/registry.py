"""The registered queries of this subpackage and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retail_lake.llm.bpe import op10_bpe_round_trip
from retail_lake.llm.divergence import OP11_SQL, op11_source_divergence
from retail_lake.llm.embeddings import OP3_SQL, op3_embedding_near_duplicates
from retail_lake.llm.exact import OP8_SQL, op8_exact_duplicates
from retail_lake.llm.licenses import op6_license_scan
from retail_lake.llm.minhash import OP2_SQL, op2_minhash_near_duplicates
from retail_lake.llm.packing import op7_packing
from retail_lake.llm.personal import op12_personal_data
from retail_lake.llm.resampling import OP13_SQL, op13_target_resampling
from retail_lake.llm.sharding import op1_rendezvous_shards
from retail_lake.llm.toxicity import op5_toxicity
from retail_lake.llm.urls import OP4_SQL, op4_url_cascade
from retail_lake.llm.warc import OP9_SQL, op9_warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_rendezvous_shards": op1_rendezvous_shards,
    "op2_minhash_near_duplicates": op2_minhash_near_duplicates,
    "op3_embedding_near_duplicates": op3_embedding_near_duplicates,
    "op4_url_cascade": op4_url_cascade,
    "op5_toxicity": op5_toxicity,
    "op6_license_scan": op6_license_scan,
    "op7_packing": op7_packing,
    "op8_exact_duplicates": op8_exact_duplicates,
    "op9_warc_round_trip": op9_warc_round_trip,
    "op10_bpe_round_trip": op10_bpe_round_trip,
    "op11_source_divergence": op11_source_divergence,
    "op12_personal_data": op12_personal_data,
    "op13_target_resampling": op13_target_resampling,
}

ORACLES: dict[str, str] = {
    "op2_minhash_near_duplicates": OP2_SQL,
    "op3_embedding_near_duplicates": OP3_SQL,
    "op4_url_cascade": OP4_SQL,
    "op8_exact_duplicates": OP8_SQL,
    "op9_warc_round_trip": OP9_SQL,
    "op11_source_divergence": OP11_SQL,
    "op13_target_resampling": OP13_SQL,
}
