"""quarry: classic data mining on Spark DataFrames.

Operators take and return DataFrames; nothing but scalars reaches the
driver. Main entry points:

* itemsets: ``Apriori``, ``item_counts``, ``FrequentSets``
* similarity: ``shingle_sets``, ``similar_pairs``, ``minhash_similar_pairs``,
  ``pair_similarity``, ``similar_groups``, ``copy_members``, ``shingle_vocabulary``
* bayes: ``fit``, ``predict``, ``cross_validate``, ``accuracy``
* rank: ``pagerank``, ``LinkGraph``
* sources: line/whole-file readers and the five parsers
"""

from .operators import bayes, itemsets, rank, similarity
from .session import build_session, cut_lineage, ensure_checkpoint_dir

__all__ = ["bayes", "itemsets", "rank", "similarity", "build_session", "cut_lineage", "ensure_checkpoint_dir"]
__version__ = "0.1.0"
