"""aerofeat — flight-delay feature engineering and modelling on Spark.

Batch and streaming feature jobs over monthly on-time-performance CSV files,
expressed as DataFrame plans: parse with rejects, sliding event-time means per
airport, feature tables with upsert and point-in-time lookup, a labelled
train/test split, a logistic-regression delay model, ROC points and a
confusion matrix.
"""

__version__ = "0.1.0"
