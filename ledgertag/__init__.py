"""Transaction labelling on Spark: labelled data sets, scoring and evaluation."""
