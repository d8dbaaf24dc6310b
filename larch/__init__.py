"""larch: table operators on Spark DataFrames.

Counting and comparing nullable columns, parsing delimited and ragged text,
rating prediction (means, ALS, ALS on residuals), frequent itemsets and
association rules, and set membership, distances and k-means over sparse
0/1 data.  Every operator is a function from DataFrames to a DataFrame; the
caller owns the SparkSession.
"""

__version__ = "0.1.0"
