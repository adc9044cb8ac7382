"""lakework: a Spark-native lakehouse for deciding what a contractor may invoice."""
