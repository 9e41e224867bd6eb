"""symcube: a Spark-native engine for labelled sparse symbol bundles."""
