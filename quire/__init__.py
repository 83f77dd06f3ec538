"""quire: segmentation, extraction and near-duplicate analytics over documents, on Spark DataFrames."""
