"""DataFrame -> DataFrame operators: cleaning, ranking, analyses, baskets, sampling."""
