"""tideline.operators"""
