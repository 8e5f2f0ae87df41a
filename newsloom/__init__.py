"""newsloom: a Spark-native engine for media-coverage analytics."""
