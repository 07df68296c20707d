"""The layers: silver, station history, gold, and the run that ties them together."""
