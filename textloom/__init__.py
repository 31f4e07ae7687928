"""textloom: document segmentation, entity resolution and review on Spark DataFrames."""
