"""Column layouts of the stored tables."""

PRICES = ("ticker string, trade_date date, ts timestamp, open_price double, high_price double, low_price double, "
          "close_price double, adj_close double, volume double, exchange string")
NEWS = ("source string, title string, summary string, published_date string, link string, matched_tickers string, "
        "fetched_at string")
REDDIT = ("subreddit string, post_id string, title string, selftext string, score int, upvote_ratio double, "
          "num_comments int, created_utc string, author string, url string, matched_tickers string, flair string, "
          "fetched_at string")
SENTIMENT = ("source_type string, source_id string, ticker string, sentiment_score double, sentiment_label string, "
             "confidence double, event_date date, processed_at string")
ANOMALIES = ("ticker string, anomaly_date date, close_price double, volume double, anomaly_score double, "
             "anomaly_type string, sentiment_avg double, description string, anomaly_ts timestamp")
MOMENTUM = ("sector string, window_days int, momentum_score double, avg_sentiment double, ticker_count int, "
            "start_date date, end_date date, computed_at string")
TABLES = {
    "stock_prices": PRICES, "news_articles": NEWS, "reddit_posts": REDDIT, "sentiment_scores": SENTIMENT,
    "price_anomalies": ANOMALIES, "sector_momentum": MOMENTUM,
}
