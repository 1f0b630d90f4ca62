"""shelfmatch.sources"""
