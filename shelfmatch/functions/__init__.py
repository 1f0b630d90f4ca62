"""shelfmatch.functions"""
