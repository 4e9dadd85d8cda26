"""paperlake: a Spark-native engine for collections of LaTeX paper sources."""
