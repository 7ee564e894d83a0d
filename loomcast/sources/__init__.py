"""Reading, joining and writing panels and forecasts."""
