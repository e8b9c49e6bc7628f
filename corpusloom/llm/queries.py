"""The queries of the training-data operators, and SQL for those that it can express."""

from corpusloom.llm.decontamination import OP8_SQL, op8_decontamination
from corpusloom.llm.knn_join import OP3_SQL, op3_knn_join
from corpusloom.llm.quality import op6_quality
from corpusloom.llm.sentencepiece_codec import op7_sentencepiece_codec
from corpusloom.llm.sharding import op9_sharding
from corpusloom.llm.simhash_dedup import op4_simhash_dedup
from corpusloom.llm.substring_dedup import OP1_SQL, op1_substring_dedup
from corpusloom.llm.token_counts import op2_token_counts
from corpusloom.llm.token_tables import op10_token_tables
from corpusloom.llm.toxicity import op5_toxicity

QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_token_counts, op3_knn_join, op4_simhash_dedup, op5_toxicity, op6_quality, op7_sentencepiece_codec, op8_decontamination, op9_sharding, op10_token_tables)}
ORACLES: dict[str, str] = {"op1_substring_dedup": OP1_SQL, "op3_knn_join": OP3_SQL, "op8_decontamination": OP8_SQL}
