"""tamiz: Spark-native cleaning, linking and profiling of delivered contact lists."""
