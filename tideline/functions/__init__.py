"""tideline.functions"""
