"""Labour flow and labour stock analytics as lazy Spark DataFrame functions."""
