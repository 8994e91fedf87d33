"""A Spark-native engine for pooled-screen analytics and for preparing training text."""
